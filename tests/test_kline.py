import json

from barwatch.sources import kline as kl


def _k(x=True, **extra):
    k = {"t": 1, "T": 60000, "i": "1m", "o": "10.0", "h": "11.0", "l": "9.5", "c": "10.5", "v": "3.0",
         "q": "30.0", "n": 7, "x": x, "V": "1.0", "Q": "10.0"}
    k.update(extra)
    return k


def test_normalize_edge_cases(spark):
    msgs = [
        json.dumps({"stream": "btcusdt@kline_1m", "data": {"e": "kline", "s": "BTCUSDT", "k": _k()}}),
        json.dumps({"e": "kline", "s": "ETHUSDT", "k": _k(extra_field=1)}),            # bare + extra field
        json.dumps({"stream": "s", "data": {"e": "kline", "s": "BTCUSDT", "k": _k(x=False)}}),  # open candle
        json.dumps({"stream": "s", "data": {"e": "trade", "s": "BTCUSDT", "k": _k()}}),  # not a kline
        json.dumps({"stream": "s", "data": {"e": "kline", "s": "BTCUSDT"}}),             # missing k
        "{not json",
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    out = kl.normalize_klines(df).collect()
    assert sorted(r.symbol for r in out) == ["BTCUSDT", "ETHUSDT"]
    r = [x for x in out if x.symbol == "BTCUSDT"][0]
    assert (r.open_time, r.close_time, r.open, r.close, r.volume, r.taker_buy_volume, r.trades) == \
        (1, 60000, 10.0, 10.5, 3.0, 1.0, 7)


def test_decode_candles_drops_malformed(spark):
    good = json.dumps({"symbol": "BTCUSDT", "interval": "1m", "open_time": 0, "close_time": 59999,
                       "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 3.0, "trades": 4,
                       "is_closed": True})
    df = spark.createDataFrame([(good,), ("garbage",), ("{}",)], "value string")
    out = kl.decode_candles(df).collect()
    assert len(out) == 1 and out[0].close == 1.5
    assert str(out[0].timestamp.time()) == "00:00:59.999000"
    dead = kl.decode_candles(df, keep_invalid=True).filter("NOT _valid").count()
    assert dead == 2


def test_pages_roundtrip(spark):
    page = json.dumps([[str(1000 * i), "1", "2", "0.5", "1.5", "9", str(1000 * i + 999), "9", "3", "1", "1", "0"]
                       for i in range(5)])
    rows = kl.klines_from_pages(spark.createDataFrame([("X", page)], "symbol string, page string")).collect()
    assert len(rows) == 5 and rows[0].high == 2.0 and rows[4].trades == 3
