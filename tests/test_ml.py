"""Invariants of the fitted detectors (fits vary with partitioning)."""

from pyspark.sql import functions as F

from barwatch.plans import ml
from tests.conftest import SF_SMALL


def test_fitted_invariants(spark):
    m = ml.fitted_methods(spark, SF_SMALL)
    n = m["zscore"].count()
    for name, col in (("kmeans", "anomaly_kmeans"), ("rf", "anomaly_rf"), ("gmm", "anomaly_gmm")):
        vals = {r[0] for r in m[name].select(col).distinct().collect()}
        assert vals <= {0, 1}
        assert m[name].count() == n
    imp = [float(v) for v in m["rf_model"].featureImportances.toArray()]
    assert abs(sum(imp) - 1.0) < 1e-9
    mp = m["gmm"].agg(F.min("max_probability"), F.max("max_probability")).first()
    assert mp[0] >= 1 / 3 - 1e-9 and mp[1] <= 1 + 1e-12


def test_consensus_votes_are_sum(spark):
    c = ml.consensus_pipeline_fit(spark, SF_SMALL)
    bad = c.filter(F.col("votes") != F.col("anomaly_zscore") + F.col("anomaly_kmeans") + F.col("anomaly_rf")
                   + F.col("anomaly_gmm")).count()
    assert bad == 0
    assert {r.final_label for r in c.select("final_label").distinct().collect()} <= {"ANOMALY", "Normal"}
