import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from helpers import T0, frame
from eventide.functions.text import format_ranking
from eventide.operators.distinct import (
    approx_distinct_per_window, bitmap_distinct_per_window, distinct_per_window, running_distinct,
)
from eventide.operators.topn import latest_per_key, sliding_top_n, top_n_per_window
from eventide.operators import Count, sliding_agg
from eventide.sources import tables as T


def py_hash(value, base=61, bits=1 << 29):
    """Plain-Python statement of the bitmap offset (test oracle)."""
    h = 0
    for ch in str(value):
        h = (h * base + ord(ch)) % bits
    return h


def test_poly_hash_matches_python(spark):
    from eventide.functions.hashing import poly_hash
    vals = [0, 7, 543462, 10**17 + 3, -42, 2**63 - 1, -(2**63), 10**18, -(10**18) + 1]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    for integral in (False, True):
        got = {r.v: r.h for r in df.select("v", poly_hash("v", integral=integral).alias("h")).collect()}
        assert got == {v: py_hash(v) for v in vals}, integral


def _events(spark, n=300, seed=3):
    random.seed(seed)
    data = [(random.randint(1, 25), T0 + random.randint(0, 4 * 3600)) for _ in range(n)]
    return frame(spark, "user_id long, ts_s long", data), data


def test_distinct_family(spark):
    df, data = _events(spark)
    df = df.withColumn("seq", F.monotonically_increasing_id())
    exact = {}
    for u, t in data:
        exact.setdefault((t - t % 3600 + 3600) * 1000, set()).add(u)
    assert rows(distinct_per_window(df, "user_id", "1 hour"), "window_end", "uv") == \
        sorted((k, len(v)) for k, v in exact.items())
    bitmap = {k: len({py_hash(u) for u in v}) for k, v in exact.items()}
    assert rows(bitmap_distinct_per_window(df, "user_id", "1 hour"), "window_end", "uv") == sorted(bitmap.items())
    approx = dict(rows(approx_distinct_per_window(df, "user_id", "1 hour"), "window_end", "uv"))
    assert set(approx) == set(exact)
    assert all(abs(approx[k] - len(v)) <= 2 for k, v in exact.items())
    # sliding exact distinct = brute force
    sl = {}
    for u, t in data:
        last = t - t % 600
        for s in range(last, t - 3600, -600):
            sl.setdefault((s + 3600) * 1000, set()).add(u)
    assert rows(distinct_per_window(df, "user_id", "1 hour", "10 minutes"), "window_end", "uv") == \
        sorted((k, len(v)) for k, v in sl.items())


def test_running_distinct_matches_loop(spark):
    random.seed(11)
    data = [(random.randint(1, 15), T0 + random.randint(0, 2 * 3600), i) for i in range(250)]
    df = frame(spark, "user_id long, ts_s long, seq long", data)
    for hashed in (True, False):
        seen, expect = {}, []
        for u, t, i in sorted(data, key=lambda r: (r[1], r[2])):
            we = (t - t % 3600 + 3600) * 1000
            s = seen.setdefault(we, set())
            s.add(py_hash(u) if hashed else u)
            expect.append((i, we, len(s)))
        got = rows(running_distinct(df, "user_id", "1 hour", hashed=hashed, sub_bucket="7 minutes"),
                   "seq", "window_end", "uv")
        assert got == sorted(expect)


def test_top_n_ties_and_limit_plan(spark):
    df = spark.createDataFrame(
        [(1000, "b", 5), (1000, "a", 5), (1000, "c", 9), (1000, "d", 1), (2000, "z", 1)],
        "window_end long, url string, cnt long")
    got = rows(top_n_per_window(df, 2, "cnt", "url"), "window_end", "rank", "url")
    assert got == [(1000, 1, "c"), (1000, 2, "a"), (2000, 1, "z")]
    plan = top_n_per_window(df, 2, "cnt", "url")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sliding_top_n_and_report(spark):
    base = T0 - T0 % 3600
    data = [(1, base + 10), (1, base + 20), (2, base + 30), (3, base + 40), (3, base + 50), (3, base + 60)]
    df = frame(spark, "item_id long, ts_s long", data)
    e1, e2 = (base + 1800) * 1000, (base + 3600) * 1000
    for salts in (1, 3):
        ranked = sliding_top_n(df, "1 hour", "30 minutes", [Count("cnt")], "item_id", 2, "cnt", salts=salts)
        got = rows(ranked, "window_end", "rank", "item_id", "cnt")
        assert got == [(e1, 1, 3, 3), (e1, 2, 1, 2), (e2, 1, 3, 3), (e2, 2, 1, 2)]
    ranked = sliding_top_n(df, "1 hour", "30 minutes", [Count("cnt")], "item_id", 2, "cnt")
    rep = {r.window_end: r.report for r in format_ranking(ranked, "item_id", "cnt").collect()}
    assert rep[e1].startswith("时间：")
    assert "No1: 商品ID=3 浏览量=3\nNo2: 商品ID=1 浏览量=2\n" in rep[e1]
    assert rep[e1].endswith("=" * 24)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("u", 1, 5), ("u", 2, 7), ("v", 1, 1)], "url string, ver long, cnt long")
    assert rows(latest_per_key(df, "url", "ver"), "url", "cnt") == [("u", 7), ("v", 1)]


def test_hot_items_report_on_driver_table(spark):
    from eventide.plans import jobs
    b = T.as_user_behavior(T.events(spark, SF_SMALL))
    top = jobs.hot_items(b, pv=T.VIEW)
    rep = jobs.hot_items_report(b, pv=T.VIEW)
    n = top.select("window_end").distinct().count()
    assert n > 0 and rep.count() == n


def test_bitmaps_merge_across_runs(spark):
    from eventide.operators.distinct import merge_bitmaps
    df, data = _events(spark, n=200, seed=8)
    half1, half2 = df.filter("user_id % 2 = 0"), df.filter("user_id % 2 = 1")
    stored = bitmap_distinct_per_window(half1, "user_id", "1 hour", keep_bitmaps=True).unionByName(
        bitmap_distinct_per_window(half2, "user_id", "1 hour", keep_bitmaps=True))
    assert rows(merge_bitmaps(stored), "window_end", "uv") == \
        rows(bitmap_distinct_per_window(df, "user_id", "1 hour"), "window_end", "uv")


def test_order_key_roundtrip_and_order(spark):
    from eventide.operators.distinct import _order_key, _order_key_seq
    vals = [(-62_135_596_800_000_000, -(2**63)), (-1, 2**63 - 1), (0, 0), (0, 1),
            (253_402_300_799_999_999, -5), (1_700_000_000_000_000, 2**62)]
    df = spark.createDataFrame(vals, "us long, seq long")
    got = df.select("us", "seq", _order_key(F.col("us"), F.col("seq")).alias("k")).collect()
    assert [r.seq for r in df.select(_order_key_seq(_order_key(F.col("us"), F.col("seq"))).alias("seq")).collect()] \
        == [v[1] for v in vals]
    assert [(r.us, r.seq) for r in sorted(got, key=lambda r: r.k)] == sorted(vals)


def test_sliding_top_n_by_spans_equals_ranking_every_window(spark):
    random.seed(5)
    data = [(random.choice([None, *range(9)]), T0 + random.randint(0, 9000)) for _ in range(400)]
    data += [(1, T0 + 40_000), (2, T0 + 40_000), (2, T0 + 90_000)]          # long gaps and ties
    df = frame(spark, "item_id long, ts_s long", data)
    counts = sliding_agg(df, "10 minutes", "5 seconds", [Count("cnt")], keys=["item_id"], method="expand")
    cols = ["window_end", "rank", "item_id", "cnt"]
    expect = rows(top_n_per_window(counts, 3, "cnt", "item_id").fillna(-1), *cols)
    for salts in (1, 3):
        got = sliding_top_n(df, "10 minutes", "5 seconds", [Count("cnt")], "item_id", 3, "cnt", salts=salts)
        assert rows(got.fillna(-1), *cols) == expect, salts
