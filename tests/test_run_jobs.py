"""The reference's jobs end to end on small hand-written text files."""

import os
import re
import tempfile

import pytest

from conftest import rows
from eventide.plans.run import JOBS, OUTCOMES, read_branch, run_job, run_outcome

T = 1_600_000_000


def _file(text):
    d = tempfile.mkdtemp(prefix="eventide-job-")
    p = os.path.join(d, "in.txt")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_all_jobs_listed():
    assert len(JOBS) == 13


def test_behaviour_jobs(spark):
    base = T - T % 3600
    lines = [f"{u},{i},1,pv,{base + s}" for u, i, s in
             [(1, 10, 5), (2, 10, 60), (3, 11, 70), (1, 12, 4000), (1, 12, 4100)]] + [f"9,10,1,buy,{base + 80}"]
    p = _file("\n".join(lines) + "\n")
    pv = rows(run_job(spark, "page_views", [p])["result"], "window_end", "pv")
    assert pv == [((base + 3600) * 1000, 3), ((base + 7200) * 1000, 2)]
    uv = rows(run_job(spark, "unique_visitors", [p])["result"], "window_end", "uv")
    assert uv == [((base + 3600) * 1000, 3), ((base + 7200) * 1000, 1)]
    top = run_job(spark, "hot_items", [p])["result"]
    first = sorted(r for r in rows(top, "window_end", "rank", "item_id", "cnt") if r[0] == (base + 300) * 1000)
    assert first == [((base + 300) * 1000, 1, 10, 2), ((base + 300) * 1000, 2, 11, 1)]
    run_uv = rows(run_job(spark, "unique_visitors_bitmap", [p])["result"], "uv")
    assert sorted(r[0] for r in run_uv) == [1, 1, 1, 2, 3]  # users 1,2,3 then user 1 twice


def test_ad_login_order_receipt_jobs(spark):
    clicks = _file("".join(f"7,1,north,c,{T + i}\n" for i in range(4)) + f"8,1,south,c,{T}\n")
    out = run_job(spark, "ad_blacklist", [clicks])
    assert sum(r.cnt for r in out["province_counts"].collect()) == 5  # cap 100 never binds
    assert out["warnings"].count() == 0

    logins = _file(f"1,ip,fail,{T}\n2,ip,fail,{T + 1}\n1,ip,success,{T + 9}\n")
    got = rows(run_job(spark, "login_failures", [logins])["result"], "user_id", "first_time", "last_time")
    assert got == [(1, T, T + 1)]

    orders = _file(f"a,create,,{T}\na,pay,p1,{T + 60}\nb,create,,{T}\nb,pay,p2,{T + 901}\nc,pay,p3,{T}\n")
    res = run_job(spark, "order_timeout", [orders])
    assert rows(res["paid"], "order_id", "msg") == [("a", "pay success")]
    assert rows(res["timed_out"], "order_id", "msg") == [("b", "pay timeout")]

    receipts = _file(f"p1,wechat,{T + 50}\np2,alipay,{T + 2000}\nzz,alipay,{T}\n")
    m = run_job(spark, "receipt_match", [orders, receipts])
    assert rows(m["matched"], "pay_id") == [("p1",), ("p2",)]
    assert rows(m["left_only"], "pay_id") == [("p3",)]
    assert rows(m["right_only"], "pay_id") == [("zz",)]
    j = run_job(spark, "receipt_interval_join", [orders, receipts])["result"]
    assert rows(j, "pay_id", "receipt_pay_type") == [("p1", "wechat")]


def test_marketing_and_urls_jobs(spark):
    ms = T * 1000
    mk = _file(f"u1,CLICK,APPLE,{ms}\nu2,UNINSTALL,APPLE,{ms + 1}\nu3,INSTALL,OPPO,{ms + 2}\n")
    tot = run_job(spark, "marketing_total", [mk])["result"]
    assert {r.cnt for r in tot.collect()} == {2}
    assert dict(tot.dtypes)["window_end"] == "string"
    log = _file(f"10.0.0.1 - - 13/09/2020:12:26:40 +0000 GET /a\n10.0.0.2 - - 13/09/2020:12:26:41 +0000 GET /a\n"
                f"10.0.0.3 - - 13/09/2020:12:26:42 +0000 GET /b\n")
    top = run_job(spark, "top_urls", [log])["result"]
    assert {(r.rank, r.url, r.cnt) for r in top.collect()} == {(1, "/a", 2), (2, "/b", 1)}


def _case(name):
    import test_bounded as B
    return [make() for make in B.INPUTS[name]]


@pytest.mark.parametrize("name", sorted(OUTCOMES))
def test_side_outputs_in_one_pass(spark, name):
    inputs = _case(name)
    readers = JOBS[name][0]
    outcome = OUTCOMES[name](*[r(spark, p) for r, p in zip(readers, inputs)])
    expected = run_job(spark, name, inputs)
    assert set(outcome.branches) == set(expected)
    out = tempfile.mkdtemp(prefix="eventide-outcome-")
    counts = run_outcome(spark, name, inputs, out)
    for branch, df in expected.items():
        got = read_branch(spark, name, inputs, out, branch)
        assert set(got.columns) == set(df.columns)
        assert [got.schema[c].dataType for c in df.columns] == [df.schema[c].dataType for c in df.columns]
        assert sorted(map(str, rows(got, *df.columns))) == sorted(map(str, rows(df, *df.columns))), branch
        assert counts[branch] == df.count()
    assert sum(counts.values()) > 0
    # one scan of each input, all else reuses its shuffle
    outcome.frame.collect()
    plan = outcome.frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"FileScan text", plan)) == len(inputs)
    # and one parse of each line
    assert len(re.findall(r"explode\(array\(from_csv", plan)) == len(re.findall(r"from_csv\(", plan)) == len(inputs)


def test_outcome_with_malformed_lines(spark):
    p = _file(f"a,create,,{T}\na,pay,p1,{T + 60}\nb,create,,soon\nb,pay\n")
    out = tempfile.mkdtemp(prefix="eventide-outcome-bad-")
    assert run_outcome(spark, "order_timeout", [p], out, malformed=True) == {"paid": 1, "timed_out": 0}
    bad = spark.read.parquet(os.path.join(out, "branch=malformed"))
    assert rows(bad, "input", "line", "reason") == [(1, 3, "ts_s is no bigint: soon"), (1, 4, "4 fields expected, found 2")]
    assert read_branch(spark, "order_timeout", [p], out, "timed_out").count() == 0
