"""Detector queries (J, K series, C1/C2/C4, D11, F2-F5).

Two kinds:
* fitted (MLlib k-means, random forest, GMM; names with ``fit``): fit results
  depend on partitioning even with a fixed seed, so they are checked by
  invariants (tests) and rows-only at the driver. ``kmeans_fit_detector`` fits
  by Lloyd's rounds from given centres instead and has an oracle;
* pinned (fixed centres, forest and mixture, statistics fitted in SQL):
  the scoring path, checked against the DuckDB oracle. Tests show that a fitted
  forest and a fitted mixture score the same through it.
"""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from barwatch.functions import flags as fl
from barwatch.operators import detectors as dt
from barwatch.operators import features as fe
from barwatch.operators import forest as rf
from barwatch.operators import report as rp
from barwatch.operators.joins import BAR_KEY, join_methods, join_pseudo_labels, keyed_join
from barwatch.plans import sql as q
from barwatch.plans.batch import features, zscore_flags
from barwatch.plans.catalog import r9, register, rounded
from barwatch.session import materialize

FEATS = fe.FEATURES

# A pinned test model in standardised feature space (3
# centres over the six features; a diagonal 3-component mixture).
PINNED_CENTERS = [
    [0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.0, 1.0, 1.0, 1.0, 1.0, 1.0],
    [-1.0, -1.0, 1.0, -1.0, -1.0, 1.0],
]
PINNED_GMM_WEIGHTS = [0.5, 0.3, 0.2]
PINNED_GMM_MEANS = [
    [0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.5, 1.5, 1.5, 1.5, 1.5, 1.5],
    [-1.0, -1.0, -1.0, -1.0, -1.0, -1.0],
]
PINNED_GMM_VARIANCES = [
    [1.0, 1.0, 1.0, 1.0, 1.0, 1.0],
    [2.0, 2.0, 2.0, 2.0, 2.0, 2.0],
    [0.5, 0.5, 0.5, 0.5, 0.5, 0.5],
]
PINNED_GMM_DIAGONAL = [[[v if i == j else 0.0 for j in range(len(FEATS))] for i, v in enumerate(row)] for row in PINNED_GMM_VARIANCES]

# A pinned mixture with full covariances, variance v and
# correlation r ** |i - j| between features i and j; means as above.
PINNED_FULL_SHAPES = [(1.0, 0.6), (2.5, 0.3), (0.8, -0.4)]
PINNED_FULL = [[[v * r ** abs(i - j) for j in range(len(FEATS))] for i in range(len(FEATS))] for v, r in PINNED_FULL_SHAPES]

# A pinned forest over the standardised features (0 return,
# 1 log_return, 2 volatility_24h, 3 volume_change, 4 volume_ratio, 5 price_range).
PINNED_FOREST = [
    rf.Split(4, 1.5, rf.Split(5, 1.8, rf.Leaf(950.0, 5.0), rf.Leaf(12.0, 20.0)), rf.Leaf(3.0, 30.0)),
    rf.Split(0, 2.0, rf.Split(0, -2.0, rf.Leaf(4.0, 16.0), rf.Split(3, 1.4, rf.Leaf(900.0, 8.0), rf.Leaf(20.0, 14.0))), rf.Leaf(2.0, 18.0)),
    rf.Split(3, 1.2, rf.Split(2, 2.2, rf.Leaf(930.0, 10.0), rf.Leaf(9.0, 11.0)), rf.Split(1, 0.5, rf.Leaf(40.0, 12.0), rf.Leaf(1.0, 9.0))),
    rf.Split(1, -1.9, rf.Leaf(5.0, 15.0), rf.Split(1, 1.9, rf.Split(4, 2.1, rf.Leaf(920.0, 9.0), rf.Leaf(2.0, 13.0)), rf.Leaf(3.0, 17.0))),
    rf.Split(5, 1.6, rf.Split(4, 1.9, rf.Leaf(940.0, 12.0), rf.Leaf(8.0, 9.0)), rf.Split(2, 0.3, rf.Leaf(10.0, 8.0), rf.Leaf(6.0, 22.0))),
]
LLOYD_ROUNDS = 20


# --- oracle SQL -------------------------------------------------------------------

def _z_sql() -> str:
    stats = ", ".join(f'avg("{f}") AS "m{i}", stddev_samp("{f}") AS "s{i}"' for i, f in enumerate(FEATS))
    zs = ", ".join(f'("{f}" - "m{i}") / NULLIF("s{i}", 0) AS z{i}' for i, f in enumerate(FEATS))
    return f"""zst AS (SELECT {stats} FROM feats),
zz AS (SELECT f.*, {zs} FROM feats f CROSS JOIN zst)"""


def _sq_sql(center) -> str:
    return "0.0 + " + " + ".join(f"(z{i} - {q.lit(c)}) * (z{i} - {q.lit(c)})" for i, c in enumerate(center))


def _kmeans_sql() -> str:
    d = ", ".join(f"{_sq_sql(c)} AS d{k}" for k, c in enumerate(PINNED_CENTERS))
    best = "least(" + ", ".join(f"d{k}" for k in range(len(PINNED_CENTERS))) + ")"
    idx = "CASE " + " ".join(f"WHEN d{k} = {best} THEN {k}" for k in range(len(PINNED_CENTERS))) + " END"
    return f"""{_z_sql()},
kd AS (SELECT *, {d} FROM zz),
kc AS (SELECT *, CAST({idx} AS INTEGER) AS cluster, sqrt({best}) AS distance FROM kd),
km AS (SELECT *, CASE WHEN distance > (SELECT avg(distance) + 2.0 * stddev_samp(distance) FROM kc) THEN 1 ELSE 0 END
         AS anomaly_kmeans FROM kc)"""


def _gmm_sql() -> str:
    logs = []
    for k, (w, mu, var) in enumerate(zip(PINNED_GMM_WEIGHTS, PINNED_GMM_MEANS, PINNED_GMM_VARIANCES)):
        quad = "0.0 + " + " + ".join(f"((z{i} - {q.lit(m)}) * (z{i} - {q.lit(m)})) / {q.lit(v)}"
                                     for i, (m, v) in enumerate(zip(mu, var)))
        const = math.log(w) - 0.5 * sum(math.log(2 * math.pi * v) for v in var)
        logs.append(f"{q.lit(const)} - 0.5 * ({quad}) AS l{k}")
    n = len(PINNED_GMM_WEIGHTS)
    top = "greatest(" + ", ".join(f"l{k}" for k in range(n)) + ")"
    es = ", ".join(f"exp(l{k} - {top}) AS e{k}" for k in range(n))
    tot = " + ".join(f"e{k}" for k in range(n))
    ps = ", ".join(f"e{k} / ({tot}) AS p{k}" for k in range(n))
    mx = "greatest(" + ", ".join(f"p{k}" for k in range(n)) + ")"
    idx = "CASE " + " ".join(f"WHEN p{k} = {mx} THEN {k}" for k in range(n)) + " END"
    return f"""gl AS (SELECT *, {', '.join(logs)} FROM zz),
ge AS (SELECT *, {es} FROM gl),
gp AS (SELECT *, {ps} FROM ge),
gx AS (SELECT *, {mx} AS max_probability, CAST({idx} AS INTEGER) AS gcluster FROM gp),
gm AS (SELECT *, CASE WHEN max_probability < (SELECT quantile_disc(max_probability, 0.1) FROM gx) THEN 1 ELSE 0 END
         AS anomaly_gmm FROM gx)"""


_Z = [f"z{i}" for i in range(len(FEATS))]


def _full_sql() -> str:
    """The mixture with full covariances over CTE zz: gf with max_probability, gcluster, anomaly_gmm."""
    logs, shares = dt.mixture_sql(_Z, PINNED_GMM_WEIGHTS, PINNED_GMM_MEANS, PINNED_FULL, dt.MLLIB_FLOOR)
    n = range(len(logs))
    total = " + ".join(f"e{k}" for k in n)
    best = "greatest(" + ", ".join(f"p{k}" for k in n) + ")"
    idx = "CASE " + " ".join(f"WHEN p{k} = {best} THEN {k}" for k in n) + " END"
    return f"""gfl AS (SELECT *, {', '.join(f'{x} AS l{k}' for k, x in enumerate(logs))} FROM zz),
gfe AS (SELECT *, {', '.join(f'{x} AS e{k}' for k, x in enumerate(shares))} FROM gfl),
gfp AS (SELECT *, {', '.join(f'e{k} / ({total}) AS p{k}' for k in n)} FROM gfe),
gfx AS (SELECT *, {best} AS max_probability, CAST({idx} AS INTEGER) AS gcluster FROM gfp),
gf AS (SELECT *, CASE WHEN max_probability < (SELECT quantile_disc(max_probability, 0.1) FROM gfx) THEN 1 ELSE 0 END
         AS anomaly_gmm FROM gfx)"""


def _split_sql() -> str:
    return """CASE WHEN ('0x' || substr(md5(concat_ws('|', symbol, "interval", CAST(bar_ts AS VARCHAR))), 1, 8))::BIGINT % 100 < 80
       THEN 'train' ELSE 'test' END"""


def _forest_sql() -> str:
    """The pinned forest over CTE km (labels are its flags): rf with label, split, probability_rf, anomaly_rf."""
    return f"""rfp AS (SELECT *, CAST(anomaly_kmeans AS DOUBLE) AS label, {_split_sql()} AS split,
  {rf.forest_sql(PINNED_FOREST, _Z)} AS probability_rf FROM km),
rf AS (SELECT *, CASE WHEN probability_rf > 0.5 THEN 1 ELSE 0 END AS anomaly_rf FROM rfp)"""


def _lloyd_sql() -> str:
    """Lloyd's rounds over CTE zz from the pinned centres, then kf: cluster, distance, anomaly_kmeans."""
    d, idx, best = dt.nearest_sql(_Z, len(PINNED_CENTERS))
    return dt.lloyd_sql("zz", _Z, PINNED_CENTERS, LLOYD_ROUNDS) + f""",
lkd AS (SELECT *, {d} FROM zz, lc{LLOYD_ROUNDS}),
lkc AS (SELECT *, CAST({idx} AS INTEGER) AS cluster, sqrt({best}) AS distance FROM lkd),
kf AS (SELECT *, CASE WHEN distance > (SELECT avg(distance) + 2.0 * stddev_samp(distance) FROM lkc) THEN 1 ELSE 0 END
         AS anomaly_kmeans FROM lkc)"""


def _sel(cols):
    return ", ".join(f'"{c}"' for c in cols)


_KM = f"""{q.with_features()},
{_kmeans_sql()}"""


# --- pinned scoring ---------------------------------------------------------------

def kmeans_pinned(spark, sf_dir):
    return dt.kmeans_score_pinned(features(spark, sf_dir, keep=True), FEATS, PINNED_CENTERS)


def gmm_pinned(spark, sf_dir, feats_df=None):
    f = feats_df if feats_df is not None else features(spark, sf_dir, keep=True)
    return dt.gmm_score_pinned(f, FEATS, PINNED_GMM_WEIGHTS, PINNED_GMM_MEANS, PINNED_GMM_DIAGONAL)


@register("assemble_scale", sql=f"""{q.with_features()},
{_z_sql()}
SELECT symbol, "interval", bar_ts, {', '.join(r9(f'z{i}', f'{f}_scaled') for i, f in enumerate(FEATS))} FROM zz""")
def assemble_scale(spark, sf_dir):
    """K1: VectorAssembler + StandardScaler (mean 0, sample std 1) over the feature table."""
    _, x = dt.assemble_scale(features(spark, sf_dir, keep=True), FEATS)
    arr = dt.vector_array("features")
    return rounded(x.select(*BAR_KEY, *[arr[i].alias(f"{f}_scaled") for i, f in enumerate(FEATS)]))


@register("kmeans_distance", sql=f"""{_KM}
SELECT symbol, "interval", bar_ts, cluster, {r9('distance')} FROM km""")
def kmeans_distance(spark, sf_dir):
    """Nearest pinned centre and Euclidean distance (native, no UDF)."""
    return rounded(kmeans_pinned(spark, sf_dir).select(*BAR_KEY, "cluster", "distance"))


@register("kmeans_detector", sql=f"""{_KM}
SELECT symbol, "interval", bar_ts, cluster, {r9('distance')}, anomaly_kmeans FROM km""")
def kmeans_detector(spark, sf_dir):
    """K2 scoring (pinned centres): distance > mu + 2 sigma of all distances."""
    return rounded(kmeans_pinned(spark, sf_dir).select(*BAR_KEY, "cluster", "distance", "anomaly_kmeans"))


@register("lookup_centroid", sql=f"""{_KM}
SELECT symbol, "interval", bar_ts, cluster,
  {', '.join(f"CASE cluster {' '.join(f'WHEN {k} THEN {q.lit(c[i])}' for k, c in enumerate(PINNED_CENTERS))} END AS c{i}" for i in range(len(FEATS)))}
FROM km""")
def lookup_centroid(spark, sf_dir):
    """C4: each row's centroid coordinates by cluster id (broadcast of k rows)."""
    cents = spark.createDataFrame([(k, *map(float, c)) for k, c in enumerate(PINNED_CENTERS)],
                                  "cluster int, " + ", ".join(f"c{i} double" for i in range(len(FEATS))))
    x = kmeans_pinned(spark, sf_dir).select(*BAR_KEY, "cluster")
    return x.join(F.broadcast(cents), "cluster", "left").select(*BAR_KEY, "cluster",
                                                                 *[f"c{i}" for i in range(len(FEATS))])


@register("top_distance", sql=f"""{_KM}
SELECT symbol, bar_ts, {r9('close')}, {r9('"return"', 'return')}, cluster, {r9('distance')} FROM km
WHERE anomaly_kmeans = 1 ORDER BY distance DESC, symbol, bar_ts LIMIT 10""")
def top_distance(spark, sf_dir):
    """10 largest distances among flagged rows (key tie-break)."""
    x = kmeans_pinned(spark, sf_dir).filter(F.col("anomaly_kmeans") == 1)
    x = x.select("symbol", "bar_ts", "close", "return", "cluster", "distance")
    return rounded(rp.top_k(x, [F.col("distance").desc(), F.col("symbol"), F.col("bar_ts")], 10))


@register("join_pseudo_labels", sql=f"""{_KM}
SELECT symbol, "interval", bar_ts, {', '.join(r9(f'"{f}"', f) for f in FEATS)}, CAST(anomaly_kmeans AS DOUBLE) AS label
FROM km""")
def join_pseudo_labels_q(spark, sf_dir):
    """Features joined with the k-means flag as a double label (natural key)."""
    f = features(spark, sf_dir, keep=True)
    km = dt.kmeans_score_pinned(f, FEATS, PINNED_CENTERS)
    return rounded(join_pseudo_labels(f.select(*BAR_KEY, *FEATS), km).select(*BAR_KEY, *FEATS, "label"))


@register("random_split", sql=f"""{q.with_features()}
SELECT symbol, "interval", bar_ts,
  {_split_sql()} AS split
FROM feats""")
def random_split(spark, sf_dir):
    """K3: 80/20 split by md5 of the natural key — partitioning-independent."""
    return dt.hash_split(features(spark, sf_dir).select(*BAR_KEY), BAR_KEY, 80)


_GM = f"""{q.with_features()},
{_z_sql()},
{_gmm_sql()}"""


@register("gmm_pinned_detector", sql=f"""{_GM}
SELECT symbol, "interval", bar_ts, gcluster AS cluster, {r9('max_probability')}, anomaly_gmm FROM gm""")
def gmm_pinned_detector(spark, sf_dir):
    """K6 scoring (pinned mixture): max posterior below its 10th percentile."""
    return rounded(gmm_pinned(spark, sf_dir).select(*BAR_KEY, "cluster", "max_probability", "anomaly_gmm"))


_CONS_SQL = f"""{q.with_features()},
{q.zscore_cte()},
{_kmeans_sql()},
{_gmm_sql()},
votes AS (
  SELECT z.symbol, z."interval", z.bar_ts, z.close, z."return", z.anomaly_zscore, k.anomaly_kmeans, g.anomaly_gmm,
    z.anomaly_zscore + k.anomaly_kmeans + g.anomaly_gmm AS votes
  FROM zs z JOIN km k ON z.symbol = k.symbol AND z.bar_ts = k.bar_ts
            JOIN gm g ON z.symbol = g.symbol AND z.bar_ts = g.bar_ts),
cons AS (SELECT *, CASE WHEN votes >= 2 THEN 'ANOMALY' ELSE 'Normal' END AS final_label FROM votes)"""

CONS_OUT = ["symbol", "interval", "bar_ts", "close", "return", "anomaly_zscore", "anomaly_kmeans", "anomaly_gmm",
            "votes", "final_label"]


FLAGS = {"zscore": "anomaly_zscore", "kmeans": "anomaly_kmeans", "rf": "anomaly_rf", "gmm": "anomaly_gmm"}


def scored_frame(spark, sf_dir, covariances=PINNED_GMM_DIAGONAL, floor: float = 0.0):
    """All pinned detectors chained on one feature table: each adds its columns, no
    detector's output is joined back. Whole-table statistics come from the
    feature table itself, one pass each."""
    f = features(spark, sf_dir, keep=True)
    x = dt.scale_columns(zscore_flags(spark, sf_dir, f), FEATS, over=f)
    x = dt.kmeans_score_pinned(x, FEATS, PINNED_CENTERS, over=f)
    x = dt.gmm_score_pinned(x, FEATS, PINNED_GMM_WEIGHTS, PINNED_GMM_MEANS, covariances, floor=floor, over=f, cluster="gmm_cluster")
    x = rf.forest_score(x, PINNED_FOREST, [F.col(c) for c in dt.scaled_names(FEATS)])
    return dt.hash_split(x.withColumn("label", F.col("anomaly_kmeans").cast("double")), BAR_KEY, 80)


def voted(x, methods=("zscore", "kmeans", "gmm"), min_votes: int = 2):
    """Votes of the given methods and the final label (``methods`` may leave any out)."""
    x = x.withColumn("votes", fl.votes([FLAGS[m] for m in methods]))
    return x.withColumn("final_label", fl.final_label("votes", min_votes))


def consensus_pinned(spark, sf_dir):
    return voted(scored_frame(spark, sf_dir))


@register("consensus_vote", sql=f"""{_CONS_SQL}
SELECT symbol, "interval", bar_ts, {r9('close')}, {r9('"return"', 'return')}, anomaly_zscore, anomaly_kmeans,
  anomaly_gmm, votes, final_label FROM cons""")
def consensus_vote(spark, sf_dir):
    """K8 (pinned, configured methods zscore + kmeans + gmm) on one frame: votes,
    final label (>= 2)."""
    return rounded(consensus_pinned(spark, sf_dir).select(*CONS_OUT))


@register("final_label", sql=f"""{_CONS_SQL}
SELECT final_label, count(*) AS "count" FROM cons GROUP BY final_label""")
def final_label_q(spark, sf_dir):
    """ANOMALY / Normal counts from the consensus votes."""
    return consensus_pinned(spark, sf_dir).groupBy("final_label").agg(F.count(F.lit(1)).alias("count"))


@register("compare_methods", sql=f"""{_CONS_SQL},
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE anomaly_zscore = 1) AS zscore,
   count(*) FILTER (WHERE anomaly_kmeans = 1) AS kmeans, count(*) FILTER (WHERE anomaly_gmm = 1) AS gmm,
   count(*) FILTER (WHERE votes >= 2) AS consensus FROM cons)
SELECT 'zscore' AS method, zscore AS anomalies, {r9('zscore * 100.0 / n', 'percent')} FROM tot
UNION ALL SELECT 'kmeans', kmeans, {r9('kmeans * 100.0 / n')} FROM tot
UNION ALL SELECT 'gmm', gmm, {r9('gmm * 100.0 / n')} FROM tot
UNION ALL SELECT 'consensus', consensus, {r9('consensus * 100.0 / n')} FROM tot""")
def compare_methods(spark, sf_dir):
    """Anomalies and percent per method and for the consensus, one pass + unpivot."""
    c = consensus_pinned(spark, sf_dir)
    wide = c.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_zscore") == 1).alias("zscore"),
                 F.count_if(F.col("anomaly_kmeans") == 1).alias("kmeans"),
                 F.count_if(F.col("anomaly_gmm") == 1).alias("gmm"),
                 F.count_if(F.col("votes") >= 2).alias("consensus"))
    long = wide.selectExpr("n", "stack(4, 'zscore', zscore, 'kmeans', kmeans, 'gmm', gmm, "
                                "'consensus', consensus) AS (method, anomalies)")
    return rounded(long.select("method", "anomalies", (F.col("anomalies") * 100.0 / F.col("n")).alias("percent")))


@register("top_votes", sql=f"""{_CONS_SQL}
SELECT symbol, bar_ts, {r9('close')}, votes, final_label FROM cons WHERE votes >= 2
ORDER BY votes DESC, symbol, bar_ts LIMIT 10""")
def top_votes(spark, sf_dir):
    """10 rows with the most votes (key tie-break)."""
    c = consensus_pinned(spark, sf_dir).filter(F.col("votes") >= 2).select("symbol", "bar_ts", "close", "votes",
                                                                          "final_label")
    return rounded(rp.top_k(c, [F.col("votes").desc(), F.col("symbol"), F.col("bar_ts")], 10))


# --- Lloyd fit, pinned forest, full-covariance mixture ----------------------------

@register("kmeans_fit_detector", sql=f"""{q.with_features()},
{_z_sql()},
{_lloyd_sql()}
SELECT symbol, "interval", bar_ts, cluster, {r9('distance')}, anomaly_kmeans FROM kf""")
def kmeans_fit_detector(spark, sf_dir):
    """K2 fit: Lloyd's rounds on the scaled features from given centres until they
    rest, then distance > mu + 2 sigma."""
    f = features(spark, sf_dir, keep=True)
    names = dt.scaled_names(FEATS)
    scaled = materialize(dt.scale_columns(f, FEATS).select(*BAR_KEY, *names), "scaled")
    centers = dt.lloyd(scaled, names, PINNED_CENTERS, LLOYD_ROUNDS)
    x = dt.flag_by_mean_k_std(dt.nearest_center(scaled, [F.col(n) for n in names], centers), "distance")
    return rounded(x.select(*BAR_KEY, "cluster", "distance", "anomaly_kmeans"))


_RF = f"""{_KM},
{_forest_sql()}"""


def forest_pinned(spark, sf_dir):
    """Bars with k-means labels, the 80/20 split and the pinned forest's score."""
    x = dt.kmeans_score_pinned(dt.scale_columns(features(spark, sf_dir, keep=True), FEATS), FEATS, PINNED_CENTERS)
    x = rf.forest_score(x, PINNED_FOREST, [F.col(c) for c in dt.scaled_names(FEATS)])
    return dt.hash_split(x.withColumn("label", F.col("anomaly_kmeans").cast("double")), BAR_KEY, 80)


@register("rf_detector", sql=f"""{_RF}
SELECT symbol, "interval", bar_ts, label, {r9('probability_rf')}, anomaly_rf, split FROM rf""")
def rf_detector(spark, sf_dir):
    """K4 scoring: a forest compiled to conditions, over every bar, beside its k-means pseudo-label."""
    return rounded(forest_pinned(spark, sf_dir).select(*BAR_KEY, "label", "probability_rf", "anomaly_rf", "split"))


_IMP = f"""{_RF},
train AS (SELECT * FROM rf WHERE split = 'train'),
{rf.importances_sql('train', PINNED_FOREST, _Z, 'label', FEATS)}"""


def _importance(spark, sf_dir):
    train = materialize(forest_pinned(spark, sf_dir).filter("split = 'train'").select("label", *dt.scaled_names(FEATS)), "train")
    return rf.importances(train, PINNED_FOREST, [F.col(c) for c in dt.scaled_names(FEATS)], "label", FEATS)


@register("rf_importance", sql=f"""{_IMP}
SELECT feature, {r9('importance')} FROM imp""")
def rf_importance(spark, sf_dir):
    """K5: impurity decrease of each feature over the training rows, by node paths."""
    return rounded(_importance(spark, sf_dir))


@register("feature_importance_rank", sql=f"""{_IMP}
SELECT feature, {r9('importance')}, CAST(row_number() OVER (ORDER BY round(importance, 9) DESC, feature) AS INTEGER) AS rank FROM imp""")
def feature_importance_rank(spark, sf_dir):
    """features ranked by importance, 1 = highest (ties by name)."""
    order = Window.orderBy(F.col("importance").desc(), "feature")                     # one row a feature
    return rounded(_importance(spark, sf_dir)).withColumn("rank", F.row_number().over(order))


@register("rf_metrics", sql=f"""{_RF},
t AS (SELECT CAST(label AS INTEGER) AS y, anomaly_rf AS p FROM rf WHERE split = 'test'),
n AS (SELECT count(*) AS n FROM t),
c AS (SELECT k, count(*) FILTER (WHERE y = k) AS actual, count(*) FILTER (WHERE p = k) AS said, count(*) FILTER (WHERE y = k AND p = k) AS hit
      FROM t, (VALUES (0), (1)) v(k) GROUP BY k),
m AS (SELECT k, actual, hit, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS pr, CASE WHEN actual > 0 THEN hit / actual ELSE 0 END AS re FROM c)
SELECT {r9('sum(hit) / any_value(n)', 'accuracy')}, {r9('sum(actual * pr) / any_value(n)', 'weighted_precision')},
  {r9('sum(actual * re) / any_value(n)', 'weighted_recall')},
  {r9('sum(actual * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / any_value(n)', 'f1')} FROM m, n""")
def rf_metrics(spark, sf_dir):
    """D14 on the forest's test split: accuracy, weighted precision/recall/F1."""
    test = forest_pinned(spark, sf_dir).filter(F.col("split") == "test")
    return rounded(rp.classification_metrics(test, "label", "anomaly_rf"))


_GF = f"""{q.with_features()},
{_z_sql()},
{_full_sql()}"""


def gmm_full(spark, sf_dir):
    return dt.gmm_score_pinned(features(spark, sf_dir, keep=True), FEATS, PINNED_GMM_WEIGHTS, PINNED_GMM_MEANS, PINNED_FULL,
                               floor=dt.MLLIB_FLOOR)


@register("gmm_detector", sql=f"""{_GF}
SELECT symbol, "interval", bar_ts, gcluster AS cluster, {r9('max_probability')}, anomaly_gmm FROM gf""")
def gmm_detector(spark, sf_dir):
    """K6 scoring: a mixture with full covariances, max posterior below its 10th percentile."""
    return rounded(gmm_full(spark, sf_dir).select(*BAR_KEY, "cluster", "max_probability", "anomaly_gmm"))


@register("gmm_max_probability", sql=f"""{_GF}
SELECT symbol, "interval", bar_ts, {r9('max_probability')} FROM gf""")
def gmm_max_probability(spark, sf_dir):
    """Largest posterior per bar (native ``array_max``)."""
    return rounded(gmm_full(spark, sf_dir).select(*BAR_KEY, "max_probability"))


@register("lowest_probability", sql=f"""{_GF}
SELECT symbol, bar_ts, {r9('close')}, {r9('"return"', 'return')}, {r9('max_probability')} FROM gf WHERE anomaly_gmm = 1
ORDER BY gf.max_probability, symbol, bar_ts LIMIT 10""")
def lowest_probability(spark, sf_dir):
    """10 smallest max posteriors among GMM-flagged bars."""
    x = gmm_full(spark, sf_dir).filter(F.col("anomaly_gmm") == 1).select("symbol", "bar_ts", "close", "return", "max_probability")
    return rounded(rp.top_k(x, [F.col("max_probability"), F.col("symbol"), F.col("bar_ts")], 10))


_FOUR = f"""{q.with_features()},
{q.zscore_cte()},
{_kmeans_sql()},
{_forest_sql()},
{_full_sql()},
four AS (SELECT z.symbol, z."interval", z.bar_ts, z.close, z."return", z.anomaly_zscore, k.anomaly_kmeans, r.anomaly_rf, g.anomaly_gmm
  FROM zs z JOIN km k USING (symbol, "interval", bar_ts) JOIN rf r USING (symbol, "interval", bar_ts)
            JOIN gf g USING (symbol, "interval", bar_ts))"""


def published_methods(spark, sf_dir) -> dict:
    """The four detectors' results as each publishes them: one written table a
    method, on the natural key (all scored on one frame)."""
    x = materialize(scored_frame(spark, sf_dir, PINNED_FULL, dt.MLLIB_FLOOR).select(*BAR_KEY, "close", "return", *FLAGS.values()), "scored")
    return {m: materialize(x.select(*BAR_KEY, *(["close", "return"] if m == "zscore" else []), flag), f"results-{m}")
            for m, flag in FLAGS.items()}


def joined_methods(results: dict, methods=tuple(FLAGS)):
    """Inner join of the methods' results on the natural key."""
    first, *rest = methods
    return join_methods(results[first], [(results[m], FLAGS[m]) for m in rest])


@register("join_four_methods", sql=f"""{_FOUR}
SELECT symbol, "interval", bar_ts, {r9('close')}, {r9('"return"', 'return')}, anomaly_zscore, anomaly_kmeans, anomaly_rf, anomaly_gmm FROM four""")
def join_four_methods(spark, sf_dir):
    """Inner join of four detectors' published results on the natural key."""
    return rounded(joined_methods(published_methods(spark, sf_dir)))


@register("consensus_pipeline", sql=f"""{_FOUR},
v AS (SELECT *, anomaly_zscore + anomaly_kmeans + anomaly_rf + anomaly_gmm AS votes FROM four)
SELECT symbol, "interval", bar_ts, {r9('close')}, {r9('"return"', 'return')}, anomaly_zscore, anomaly_kmeans, anomaly_rf, anomaly_gmm,
  votes, CASE WHEN votes >= 2 THEN 'ANOMALY' ELSE 'Normal' END AS final_label FROM v""")
def consensus_pipeline(spark, sf_dir):
    """K8: four published results joined, votes and final label (>= 2)."""
    return rounded(voted(joined_methods(published_methods(spark, sf_dir)), tuple(FLAGS)))


# --- fitted models (rows-only at the driver; invariants in tests) -----------------

def fitted_methods(spark, sf_dir, with_gmm: bool = True):
    """The fitted detectors over one written feature table and one written
    standardisation (k-means, RF and, if asked for, GMM all read it).

    Returns dict of DataFrames keyed by method plus the RF model."""
    f = features(spark, sf_dir, keep=True)
    z = zscore_flags(spark, sf_dir, f)
    _, scaled = dt.assemble_scale(f, FEATS)
    scaled = materialize(scaled, "scaled")
    _, km = dt.kmeans_detect(f, FEATS, scaled=scaled)
    km = materialize(km.select(*BAR_KEY, "cluster", "distance", "anomaly_kmeans"), "kmeans")
    labelled = materialize(dt.hash_split(join_pseudo_labels(scaled, km), BAR_KEY, 80), "labelled")
    rf = dt.rf_fit(labelled.filter(F.col("split") == "train"))
    rf_out = rf.transform(labelled).select(*BAR_KEY, "label", F.col("prediction").cast("int").alias("anomaly_rf"),
                                           "split")
    out = {"zscore": z, "kmeans": km, "rf": rf_out, "rf_model": rf}
    if with_gmm:
        _, gm = dt.gmm_detect(f, FEATS, scaled=scaled)
        out["gmm"] = gm.select(*BAR_KEY, "cluster", "max_probability", "anomaly_gmm")
    return out


@register("kmeans_mllib_detector")
def kmeans_mllib_detector(spark, sf_dir):
    """K2 fit: MLlib k-means (k=3, seed 42) on scaled features, distance > mu + 2 sigma."""
    _, km = dt.kmeans_detect(features(spark, sf_dir, keep=True), FEATS)
    return rounded(km.select(*BAR_KEY, "cluster", "distance", "anomaly_kmeans"))


@register("rf_fit_detector")
def rf_fit_detector(spark, sf_dir):
    """K4: random forest (100 trees, depth 5) trained on the 80 % split with
    k-means pseudo-labels, scoring every bar."""
    return fitted_methods(spark, sf_dir, with_gmm=False)["rf"]


@register("rf_fit_importance")
def rf_fit_importance(spark, sf_dir):
    """Feature importances, highest first (sum to 1)."""
    return rounded(dt.rf_importance(fitted_methods(spark, sf_dir, with_gmm=False)["rf_model"], FEATS, spark))


@register("rf_fit_importance_rank")
def rf_fit_importance_rank(spark, sf_dir):
    """features ranked by importance, 1 = highest (ties by name)."""
    imp = dt.rf_importance(fitted_methods(spark, sf_dir, with_gmm=False)["rf_model"], FEATS, spark)          # one row a feature
    order = Window.orderBy(F.col("importance").desc(), "feature")
    return rounded(imp.withColumn("rank", F.row_number().over(order)))


@register("rf_fit_metrics")
def rf_fit_metrics(spark, sf_dir):
    """D14 on the RF test split: accuracy, weighted precision/recall/F1."""
    rf = fitted_methods(spark, sf_dir, with_gmm=False)["rf"].filter(F.col("split") == "test")
    return rounded(rp.classification_metrics(rf, "label", "anomaly_rf"))


@register("gmm_fit_detector")
def gmm_fit_detector(spark, sf_dir):
    """K6: MLlib GMM (k=3, seed 42), max posterior below its 10th percentile."""
    _, gm = dt.gmm_detect(features(spark, sf_dir, keep=True), FEATS)
    return rounded(gm.select(*BAR_KEY, "cluster", "max_probability", "anomaly_gmm"))


@register("gmm_fit_max_probability")
def gmm_fit_max_probability(spark, sf_dir):
    """Largest posterior per bar (native ``array_max``)."""
    _, gm = dt.gmm_detect(features(spark, sf_dir, keep=True), FEATS)
    return rounded(gm.select(*BAR_KEY, "max_probability"))


@register("gmm_fit_lowest_probability")
def gmm_fit_lowest_probability(spark, sf_dir):
    """10 smallest max posteriors among GMM-flagged bars."""
    _, gm = dt.gmm_detect(features(spark, sf_dir, keep=True), FEATS)
    x = gm.filter(F.col("anomaly_gmm") == 1).select("symbol", "bar_ts", "close", "return", "max_probability")
    return rounded(rp.top_k(x, [F.col("max_probability"), F.col("symbol"), F.col("bar_ts")], 10))


@register("join_four_methods_fit")
def join_four_methods_fit(spark, sf_dir):
    """Inner join of the four fitted detectors' flags on the natural key."""
    m = fitted_methods(spark, sf_dir)
    base = m["zscore"].select(*BAR_KEY, "close", "return", "anomaly_zscore")
    return rounded(join_methods(base, [(m["kmeans"], "anomaly_kmeans"), (m["rf"], "anomaly_rf"),
                                       (m["gmm"], "anomaly_gmm")]))


@register("consensus_pipeline_fit")
def consensus_pipeline_fit(spark, sf_dir):
    """K8 with the four fitted methods as in the notebooks: votes and label."""
    x = join_four_methods_fit(spark, sf_dir)
    return voted(x, tuple(FLAGS))
