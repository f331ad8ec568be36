import random

from conftest import rows
from helpers import T0, frame
from pyspark.sql import functions as F

from eventide.operators.limits import cap_per_key
from eventide.operators.patterns import followed_by, strict_pairs
from eventide.plans import jobs


def test_cap_exact_and_over(spark):
    # key (1, 10): 3 clicks, cap 3 -> all kept, no warning; key (2, 10): 5 clicks -> 3 kept, one warning
    data = [(1, 10, "p1", "c", T0 + i, i) for i in range(3)] + \
           [(2, 10, "p2", "c", T0 + 100, 10 + i) for i in range(5)]  # same second, seq decides
    df = frame(spark, "user_id long, ad_id long, province string, city string, ts_s long, seq long", data)
    res = cap_per_key(df, ["user_id", "ad_id"], 3)
    assert rows(res.kept, "user_id", "seq") == [(1, 0), (1, 1), (1, 2), (2, 10), (2, 11), (2, 12)]
    assert rows(res.warnings, "user_id", "ad_id", "seq", "msg") == [(2, 10, 13, "Input blacklist")]
    plan = res.kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cap_event_day_reset(spark):
    day = 86400
    d0 = T0 - T0 % day
    data = [(1, 1, "p", "c", d0 + 10, 0), (1, 1, "p", "c", d0 + 20, 1), (1, 1, "p", "c", d0 + day + 5, 2)]
    df = frame(spark, "user_id long, ad_id long, province string, city string, ts_s long, seq long", data)
    assert rows(cap_per_key(df, ["user_id", "ad_id"], 1).warnings, "seq") == [(1,)]
    daily = cap_per_key(df, ["user_id", "ad_id"], 1, reset="event_day")
    assert rows(daily.kept, "seq") == [(0,), (2,)]
    assert rows(daily.warnings, "seq") == [(1,)]


def test_ad_job_counts_kept_rows_per_province_hour(spark):
    base = T0 - T0 % 3600
    data = [(7, 1, "north", "x", base + i, i) for i in range(5)] + [(8, 1, "south", "y", base + 3700, 9)]
    df = frame(spark, "user_id long, ad_id long, province string, city string, ts_s long, seq long", data)
    rep = jobs.ad_clicks_by_province(df, cap=2)
    assert rows(rep.province_counts, "province", "window_end", "cnt") == \
        [("north", (base + 3600) * 1000, 2), ("south", (base + 7200) * 1000, 1)]
    assert rows(rep.warnings, "user_id", "ad_id", "seq") == [(7, 1, 2)]


def _logins(spark, data):
    return frame(spark, "user_id long, ip string, event_type string, ts_s long, seq long", data)


def test_login_two_users_one_second_apart(spark):
    # two failures of different users 1 s apart: a pair only when not keyed (as shipped)
    df = _logins(spark, [(1, "", "fail", T0, 0), (2, "", "fail", T0 + 1, 1), (1, "", "success", T0 + 5, 2)])
    assert jobs.login_failures(df, "2 seconds", keyed=True).count() == 0
    got = rows(jobs.login_failures(df, "2 seconds", keyed=False), "user_id", "first_time", "last_time")
    assert got == [(1, T0, T0 + 1)]


def test_login_within_is_strict_and_next_is_contiguous(spark):
    df = _logins(spark, [(1, "", "fail", T0, 0), (1, "", "fail", T0 + 2, 1),        # gap == within: no
                         (1, "", "fail", T0 + 3, 2),                                   # 1 s after -> pair
                         (1, "", "success", T0 + 3, 3), (1, "", "fail", T0 + 4, 4)])   # success breaks
    got = rows(jobs.login_failures(df, "2 seconds"), "first_seq", "second_seq")
    assert got == [(1, 2)]


def _py_strict(data, within, keyed):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1], r[3])):
        groups.setdefault(r[0] if keyed else None, []).append(r)
    out = []
    for g in groups.values():
        for a, b in zip(g, g[1:]):
            if a[2] and b[2] and b[1] - a[1] < within:
                out.append((a[3], b[3]))
    return sorted(out)


def test_strict_pairs_buckets_equal_loop(spark):
    random.seed(5)
    data = [(random.randint(1, 4), T0 + random.randint(0, 3000), random.random() < 0.6, i) for i in range(400)]
    df = frame(spark, "k long, ts_s long, p boolean, seq long", data)
    for keyed in (True, False):
        for method, bucket in (("copy", None), ("copy", "40 seconds"), ("copy", "17 seconds"),
                               ("chain", None), ("chain", "5 seconds"), ("chain", "300 seconds")):
            got = rows(strict_pairs(df, F.col("p"), F.col("p"), "17 seconds", keys=["k"] if keyed else [],
                                    bucket=bucket, method=method), "first_seq", "second_seq")
            assert got == _py_strict(data, 17, keyed), (keyed, method, bucket)
    # no time limit: chain only
    got = rows(strict_pairs(df, F.col("p"), F.col("p"), None, keys=["k"], bucket="60 seconds"),
               "first_seq", "second_seq")
    assert got == _py_strict(data, 10**9, True)


def test_unkeyed_pattern_is_not_single_partition(spark):
    df = _logins(spark, [(1, "", "fail", T0, 0), (2, "", "fail", T0 + 1, 1)])
    plan = jobs.login_failures(df, "2 seconds", keyed=False)._jdf.queryExecution().executedPlan().toString()
    # rows are copied to time buckets: neither they nor a summary of them meet in one task
    assert "SinglePartition" not in plan


def _orders(spark, data):
    return frame(spark, "order_id string, pay_status string, pay_id string, ts_s long, seq long", data)


def test_order_timeout_traps(spark):
    df = _orders(spark, [
        ("a", "pay", "p1", T0, 1), ("a", "create", "", T0, 0),          # same second; seq puts create first
        ("b", "create", "", T0, 2), ("b", "modify", "", T0 + 5, 3),     # extra status skipped
        ("b", "pay", "p2", T0 + 10, 4),
        ("c", "create", "", T0, 5), ("c", "pay", "p3", T0 + 900, 6),    # gap == 15 min: timeout
        ("d", "pay", "p4", T0, 7),                                      # pay without create: nothing
        ("e", "create", "", T0, 8)])                                    # never paid: timeout
    res = jobs.order_timeout(df, "15 minutes")
    assert rows(res.paid, "order_id", "create_seq", "pay_seq", "msg") == \
        [("a", 0, 1, "pay success"), ("b", 2, 4, "pay success")]
    assert rows(res.timed_out, "order_id", "msg") == [("c", "pay timeout"), ("e", "pay timeout")]


def _py_followed(data, within):
    out_m, out_t = [], []
    by = {}
    for r in sorted(data, key=lambda r: (r[1], r[4])):
        by.setdefault(r[0], []).append(r)
    for g in by.values():
        for i, a in enumerate(g):
            if not a[2]:
                continue
            f = next((b for b in g[i + 1:] if b[3]), None)
            if f is not None and f[1] - a[1] < within:
                out_m.append((a[4], f[4]))
            else:
                out_t.append(a[4])
    return sorted(out_m), sorted(out_t)


def test_followed_by_buckets_equal_loop(spark):
    random.seed(9)
    data = []
    for i in range(500):
        p = random.random() < 0.4
        data.append((random.randint(1, 5), T0 + random.randint(0, 5000), p, (not p) and random.random() < 0.5, i))
    df = frame(spark, "k long, ts_s long, p boolean, q boolean, seq long", data)
    exp_m, exp_t = _py_followed(data, 60)
    for method, bucket in (("copy", None), ("copy", "60 seconds"), ("copy", "300 seconds"),
                           ("chain", None), ("chain", "7 seconds"), ("chain", "1000 seconds")):
        res = followed_by(df, F.col("p"), F.col("q"), "60 seconds", keys=["k"], bucket=bucket, method=method)
        assert rows(res.matched, "begin_seq", "follow_seq") == exp_m, (method, bucket)
        assert [r[0] for r in rows(res.timed_out, "begin_seq")] == exp_t, (method, bucket)
    exp_m, exp_t = _py_followed(data, 10**9)
    res = followed_by(df, F.col("p"), F.col("q"), None, keys=["k"], bucket="30 seconds")
    assert rows(res.matched, "begin_seq", "follow_seq") == exp_m


def test_null_keys(spark):
    from eventide.operators import Count, tumbling_agg
    from eventide.operators.joins import pair_one_to_one
    data = [(None, T0, True, 0), (None, T0 + 1, True, 1), (1, T0 + 2, True, 2), (1, T0 + 3, True, 3)]
    df = frame(spark, "k long, ts_s long, p boolean, seq long", data)
    # aggregates and caps: null is one group (SQL semantics)
    got = {(r.k, r.cnt) for r in tumbling_agg(df, "1 hour", [Count("cnt")], keys=["k"]).collect()}
    assert got == {(None, 2), (1, 2)}
    assert rows(cap_per_key(df, ["k"], 1).warnings, "seq") == [(1,), (3,)]
    # sequence operators ignore rows without a key, whatever the strategy
    for method in ("copy", "chain"):
        got = rows(strict_pairs(df, F.col("p"), F.col("p"), "10 seconds", keys=["k"], method=method),
                   "first_seq", "second_seq")
        assert got == [(2, 3)], method
        res = followed_by(df, F.col("p"), F.col("p"), "10 seconds", keys=["k"], method=method)
        assert rows(res.matched, "begin_seq", "follow_seq") == [(2, 3)], method
    left = frame(spark, "pay_id string, ts_s long, seq long", [(None, T0, 0), ("a", T0, 1)])
    right = frame(spark, "pay_id string, ts_s long, seq long", [(None, T0 + 1, 2), ("a", T0 + 1, 3)])
    res = pair_one_to_one(left, right, "pay_id")
    assert rows(res.matched, "left_seq", "right_seq") == [(1, 3)]
    assert res.left_only.count() == 0 and res.right_only.count() == 0
