"""Model parameters: load, fall back, flatten, publish.

Parameters are configuration — a few dozen numbers — so they are parsed on
the driver and enter plans as literals (constant-folded by Catalyst) or as
a tiny per-(symbol, interval) lookup table joined on its key.
"""

from __future__ import annotations

import copy
import json
import os
import warnings
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The reference's fallback parameters (BTC 1 h batch fit).
FALLBACK_Z_THRESHOLD = 3.0
FALLBACK_STATS = {
    "return": {"mean": 0.0034, "std": 0.3741},
    "log_return": {"mean": 0.0027, "std": 0.3744},
    "price_range": {"mean": 0.4972, "std": 0.3956},
    "volume_change": {"mean": 20.9250, "std": 93.3035},
}
FALLBACK_VOLUME_SPIKE_PCT = 200.0
FALLBACK_RANGE_THRESHOLD_PCT = 1.5
FALLBACK_MIN_VOTES = 2

PARAMS_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("interval", StringType()),
    StructField("feature", StringType()),
    StructField("mean", DoubleType()),
    StructField("std", DoubleType()),
])


@dataclass
class Params:
    z_threshold: float = FALLBACK_Z_THRESHOLD
    stats: dict = field(default_factory=lambda: copy.deepcopy(FALLBACK_STATS))
    volume_spike_pct: float = FALLBACK_VOLUME_SPIKE_PCT
    range_threshold_pct: float = FALLBACK_RANGE_THRESHOLD_PCT
    min_votes: int = FALLBACK_MIN_VOTES
    kmeans_distance_threshold: float | None = None
    gmm_percentile: float = 10.0
    source: str | None = None
    raw: dict | None = None

    def mean(self, feature: str) -> float | None:
        return self._statistic(feature, "mean")

    def std(self, feature: str) -> float | None:
        return self._statistic(feature, "std")

    def _statistic(self, feature: str, name: str) -> float | None:
        """None where the fit saw no rows (JSON leaves NULL out): scores are then NULL."""
        v = self.stats[feature].get(name)
        return None if v is None else float(v)

    def table(self, spark: SparkSession, symbol: str | None = None, interval: str | None = None) -> DataFrame:
        """Flattened (symbol, interval, feature, mean, std); NULL symbol and
        interval mark the default row that applies to every series."""
        rows = [(symbol, interval, f, self.mean(f), self.std(f)) for f in sorted(self.stats)]
        return spark.createDataFrame(rows, PARAMS_SCHEMA)


def from_dict(d: dict, source: str | None = None) -> Params:
    z = d.get("zscore", {})
    simple = d.get("streaming_simplified", {})
    km = d.get("kmeans", {})
    return Params(
        z_threshold=float(z.get("threshold", FALLBACK_Z_THRESHOLD)),
        stats=copy.deepcopy(z.get("statistics", FALLBACK_STATS)),
        volume_spike_pct=float(simple.get("volume_spike_threshold_pct", FALLBACK_VOLUME_SPIKE_PCT)),
        range_threshold_pct=float(simple.get("price_range_threshold_pct", FALLBACK_RANGE_THRESHOLD_PCT)),
        min_votes=int(d.get("consensus", {}).get("min_votes", FALLBACK_MIN_VOTES)),
        kmeans_distance_threshold=km.get("distance_threshold"),
        gmm_percentile=float(d.get("gmm", {}).get("probability_threshold_percentile", 10)),
        source=source,
        raw=d,
    )


def load_params(spark: SparkSession, paths: list[str] | str | None = None) -> Params:
    """The first JSON document among ``paths`` that exists (read through
    Spark, so any file system will do); the fallback set, with a warning, if
    none does. A document that exists but does not parse is an error."""
    tried = [paths] if isinstance(paths, str) else list(paths or [])
    for p in tried:
        try:
            docs = spark.read.text(p, wholetext=True).limit(2).collect()        # one small document
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if len(docs) != 1:
            raise ValueError(f"{p}: expected one JSON document, found {len(docs)}")
        return from_dict(json.loads(docs[0]["value"]), source=p)
    warnings.warn(f"no model parameters at {tried}; the built-in fallback parameters are used", stacklevel=2)
    return Params(source=None)


def read_params_table(spark: SparkSession, path: str) -> DataFrame:
    """Distributed read of a params JSON document (``multiLine``) flattened
    to (symbol, interval, feature, mean, std) with ``stack``."""
    raw = spark.read.option("multiLine", True).json(path)
    feats = [f.name for f in raw.schema["zscore"].dataType["statistics"].dataType.fields]
    parts = ", ".join(f"'{f}', zscore.statistics.`{f}`.mean, zscore.statistics.`{f}`.std" for f in feats)
    sym = "symbol" if "symbol" in raw.columns else "CAST(NULL AS STRING)"
    itv = "`interval`" if "interval" in raw.columns else "CAST(NULL AS STRING)"
    return raw.selectExpr(f"{sym} AS symbol", f"{itv} AS `interval`",
                          f"stack({len(feats)}, {parts}) AS (feature, mean, std)") \
              .select("symbol", "interval", "feature", F.col("mean").cast("double"), F.col("std").cast("double"))


def save_params(stats_long: DataFrame, path: str, extra: dict | None = None) -> None:
    """Publish fitted statistics (K9): the long table as parquet (readable
    by the stream and by batch reports) plus a small JSON document."""
    stats_long.write.mode("overwrite").parquet(os.path.join(path, "statistics"))
    if extra is not None:
        stats_long.sparkSession.createDataFrame([(json.dumps(extra),)], "doc string") \
            .write.mode("overwrite").text(os.path.join(path, "settings"))
