"""Gapless positions within groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.session import materialize

RANK_ROWS = 500_000              # rows of a sort range, about


def ranked(rows: DataFrame, by: list[str], order: list[str], name: str = "ranked") -> DataFrame:
    """Rows with ``pos`` (from 0, by ``order`` within the group of ``by``) and ``n`` (rows of the group).

    The rows are dealt into ranges of (``by``, ``order``, row number) and sorted in
    them, so a group or a repeated value of a third of all rows spreads over many
    ranges. Each range numbers its own rows; what goes before it in a group comes
    from the sum of the ranges' counts, one row for each group and range. NULLs of
    ``by`` are a group, NULLs of ``order`` come first. Written rows make the numbers
    the same when a task runs again."""
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    total = rows.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANK_ROWS))
    keys = [*by, *order, "_row"]
    dealt = materialize(rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
                        .withColumn("_at", F.monotonically_increasing_id()).drop("_row"), f"{name}-sorted")
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    named = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    runs = dealt.groupBy(*named, F.col("_range").alias("_in")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*[f"_by{i}" for i in range(len(by))])
    before = F.coalesce(F.sum("_rows").over(group.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = materialize(runs.select(*[f"_by{i}" for i in range(len(by))], "_in", (before - F.col("_first")).alias("_shift"),
                                   F.sum("_rows").over(group).alias("n")), f"{name}-runs")
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    on = F.col("_range") == F.col("_in")
    for s in same:
        on = on & s
    return dealt.join(runs, on).select(*[c for c in dealt.columns if c not in ("_at", "_range")],
                                       (F.col("_at") + F.col("_shift")).alias("pos"), "n")
