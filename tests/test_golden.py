"""Committed stream output of the reference: recompute the derived columns
from OHLC with the fallback parameters; they must agree to the last bits."""

import pytest
from pyspark.sql import functions as F

from barwatch.operators import scoring
from barwatch.functions import features as fx
from barwatch.sources import params as pm

# Timestamp, symbol, open, high, low, close, volume, return,
# log_return, price_range, return_zscore, log_return_zscore,
# price_range_zscore (15 committed candles, all with 0 votes).
GOLDEN = [
    ("2026-02-05T17:43:59.999Z", "PAXGUSDT", 4884.01, 4884.01, 4875.06, 4879.7, 41.4179, -0.08824715756111064, -0.088286118288036, 0.18358748405147457, -0.24498037305830164, -0.24301847833342946, -0.7927515569982947),
    ("2026-02-05T17:43:59.999Z", "BTCUSDT", 66942.53, 67134.45, 66895.02, 67134.45, 58.23456, 0.2866936759037913, 0.28628349337600595, 0.3579190199808491, 0.7572672437952186, 0.7574345442735202, -0.35207527810705486),
    ("2026-02-05T17:43:59.999Z", "ETHUSDT", 1967.43, 1974.61, 1965.54, 1974.61, 1014.2309, 0.36494309835673117, 0.3642787967561994, 0.46145079723637966, 0.9664343714427457, 0.9657553332163445, -0.09036704439742244),
    ("2026-02-05T17:44:59.999Z", "PAXGUSDT", 4879.69, 4884.6, 4879.21, 4884.59, 12.6526, 0.10041621496448638, 0.10036583160922838, 0.11046870292527534, 0.259332304101808, 0.2608595929733664, -0.9775816407348954),
    ("2026-02-05T17:44:59.999Z", "BTCUSDT", 67134.48, 67134.86, 66904.97, 67109.93, 58.41624, -0.0365683922777132, -0.03657508014476269, 0.3436067604544168, -0.10683879250925742, -0.10490138927554138, -0.38825389167235386),
    ("2026-02-05T17:44:59.999Z", "ETHUSDT", 1974.61, 1974.61, 1966.72, 1973.53, 792.5748, -0.05469434470603954, -0.05470930751887888, 0.40117556134070287, -0.1552909508314342, -0.1533368256380312, -0.24273113917921413),
    ("2026-02-05T17:45:59.999Z", "PAXGUSDT", 4884.9, 4890.59, 4884.46, 4890.5, 40.7242, 0.11463898953919967, 0.11457332922634861, 0.12550005527735122, 0.29735094771237547, 0.29880696908746956, -0.9395853001078078),
    ("2026-02-05T17:45:59.999Z", "BTCUSDT", 67109.93, 67234.64, 67046.27, 67234.64, 34.90995, 0.18582942941529876, 0.18565698013906495, 0.28095522689031815, 0.487648835646348, 0.48866714780733156, -0.5466248056362027),
    ("2026-02-05T17:45:59.999Z", "ETHUSDT", 1973.53, 1978.27, 1970.52, 1978.27, 982.4034, 0.2401787659675814, 0.23989079776961209, 0.39329720073889124, 0.6329290723538664, 0.6335224299402031, -0.262646105311195),
    ("2026-02-05T17:46:59.999Z", "PAXGUSDT", 4890.6, 4897.91, 4890.6, 4897.5, 20.2308, 0.1410869831922389, 0.14098754902290075, 0.14947041262829694, 0.3680486051650332, 0.3693577698261238, -0.8789928902216961),
    ("2026-02-05T17:46:59.999Z", "BTCUSDT", 67234.64, 67340.0, 67111.21, 67251.65, 78.86235, 0.02529945873138424, 0.025296258957987643, 0.3409117493187704, 0.05853905033783545, 0.060353255763855876, -0.3950663566259595),
    ("2026-02-05T17:46:59.999Z", "ETHUSDT", 1978.29, 1980.91, 1972.47, 1977.6, 775.4977, -0.034878607282049376, -0.03488469128299906, 0.42788990453593995, -0.10232185854597535, -0.10038646176014705, -0.17520246578377155),
    ("2026-02-05T17:47:59.999Z", "PAXGUSDT", 4897.8, 4898.94, 4893.26, 4894.14, 17.7774, -0.07472742864142787, -0.07475536350192252, 0.11607803386697992, -0.20884102817810177, -0.206878641832058, -0.9634023410844794),
    ("2026-02-05T17:47:59.999Z", "BTCUSDT", 67254.68, 67313.09, 67100.0, 67124.97, 32.74604, -0.1928639018132149, -0.19305012371139252, 0.3175707898658666, -0.5246295156728545, -0.5228368688872663, -0.45406777081429056),
    ("2026-02-05T17:47:59.999Z", "ETHUSDT", 1977.6, 1979.58, 1972.22, 1974.47, 693.8562, -0.15827265372167687, -0.15839803720223317, 0.3731835190800164, -0.43216427084115705, -0.43028321902305866, -0.3134895877653781),
]
COLS = ["ts", "symbol", "open", "high", "low", "close", "volume", "e_return", "e_log_return", "e_price_range",
        "e_return_z", "e_log_return_z", "e_price_range_z"]


def test_golden_candles(spark):
    df = spark.createDataFrame(GOLDEN, COLS)
    x = (df.withColumn("return", fx.return_intrabar()).withColumn("log_return", fx.log_return_intrabar())
           .withColumn("price_range", fx.price_range_low()))
    x = scoring.candle_detector(x, pm.Params())
    rows = x.collect()
    assert len(rows) == 15
    for r in rows:
        assert r["return"] == pytest.approx(r["e_return"], abs=1e-12)
        assert r["log_return"] == pytest.approx(r["e_log_return"], abs=1e-12)
        assert r["price_range"] == pytest.approx(r["e_price_range"], abs=1e-12)
        assert r["return_zscore"] == pytest.approx(r["e_return_z"], abs=1e-12)
        assert r["log_return_zscore"] == pytest.approx(r["e_log_return_z"], abs=1e-12)
        assert r["price_range_zscore"] == pytest.approx(r["e_price_range_z"], abs=1e-12)
        assert r["candle_votes"] == 0 and r["is_candle_anomaly"] is False


def test_close_denominator_differs(spark):
    """The stream's range divides by low; the batch form by close differs."""
    df = spark.createDataFrame(GOLDEN, COLS)
    r = df.select(fx.price_range_close().alias("pc"), "e_price_range").collect()
    assert max(abs(a.pc - a.e_price_range) for a in r) > 1e-5
