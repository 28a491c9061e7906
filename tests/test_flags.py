from pyspark.sql import functions as F

from barwatch.functions import flags as fl
from barwatch.functions.numeric import finite, safe_div, safe_ln


def test_strict_threshold_and_nulls(spark):
    df = spark.createDataFrame([(3.0,), (3.0000001,), (-4.0,), (None,), (float("nan"),)], "z double")
    got = [r.f for r in df.select(fl.flag_abs_gt(finite("z"), 3.0).alias("f")).collect()]
    assert got == [0, 1, 1, 0, 0]


def test_votes_confidence_reasons(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (0, 1, 0), (0, 0, 0)], "a int, b int, c int")
    names = [("VOLATILITY", "a"), ("RANGE", "b"), ("VOLUME", "c")]
    x = df.select(fl.votes(["a", "b", "c"]).alias("v"), fl.reasons(names).alias("r"),
                  fl.reasons(names, compat=True).alias("rc"))
    x = x.select("*", fl.confidence("v").alias("conf"), fl.min_votes("v", 2).alias("anom"),
                 fl.final_label("v", 2).alias("label"))
    rows = x.collect()
    assert [r.v for r in rows] == [3, 2, 1, 0]
    assert [r.conf for r in rows] == ["HIGH", "MEDIUM", "LOW", "NONE"]
    assert [r.anom for r in rows] == [True, True, False, False]
    assert [r.label for r in rows] == ["ANOMALY", "ANOMALY", "Normal", "Normal"]
    assert [r.r for r in rows] == ["VOLATILITY | RANGE | VOLUME", "VOLATILITY | VOLUME", "RANGE", ""]
    assert rows[1].rc == "VOLATILITY |  | VOLUME"


def test_safe_math(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 2.0), (-1.0, 1.0)], "a double, b double")
    r = df.select(safe_div("a", "b").alias("d"), safe_ln(F.col("a")).alias("l")).collect()
    assert r[0].d is None and r[1].d == 0.0
    assert r[1].l is None and r[2].l is None
