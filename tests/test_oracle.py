"""Every core query with an oracle against DuckDB at sf0.001 (other sizes:
``python tests/oracle_compare.py``; the llm queries have tests of their own)."""

import pytest

import __spark_entry__ as entry
from barwatch.plans import batch, ingest, ml, reports, streams
from barwatch.plans.catalog import REGISTRY
from tests.oracle_compare import compare, duck
from tests.conftest import SF_SMALL

CORE = sorted(n for n, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module", autouse=True)
def one_feature_table():
    """The queries share one written feature table, which some thirty of them would build anew."""
    real, made = batch.features, {}

    def once(spark, sf_dir, interval="1 hour", keep=False):
        if (sf_dir, interval) not in made:
            made[sf_dir, interval] = real(spark, sf_dir, interval, keep=True)
        return made[sf_dir, interval]

    users = [m for m in (batch, ingest, ml, reports, streams) if getattr(m, "features", None) is real]
    for m in users:
        m.features = once
    yield
    for m in users:
        m.features = real


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_a_doc_and_runs_shape(spark):
    qs = entry.queries()
    assert len(qs) >= 90
    assert set(entry.oracle_sql()) <= set(qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "anomaly_zscore" in df.columns
