import os
import tempfile

import pytest

from conftest import rows
from eventide.plans.run import run_job
from eventide.sources import (
    read_access_log, read_ad_clicks, read_branches, read_logins, read_marketing, read_orders, read_receipts,
    read_user_behavior,
)


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="eventide-src-")
    p = os.path.join(d, "in.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_user_behavior_trimmed(spark):
    p = _write("101, 5001 ,77, pv ,1600000000\n102,5002,78,buy,1600000060\n")
    df = read_user_behavior(spark, p)
    assert rows(df, "user_id", "item_id", "behavior", "ts_s", "seq") == \
        [(101, 5001, "pv", 1600000000, 0), (102, 5002, "buy", 1600000060, 1)]
    assert df.schema["ts"].dataType.typeName() == "timestamp"


def test_orders_empty_pay_id_and_receipts(spark):
    o = read_orders(spark, _write("o1,create,,1600000000\no1,pay,px,1600000009\n"))
    assert rows(o, "order_id", "pay_status", "pay_id") == [("o1", "create", ""), ("o1", "pay", "px")]
    r = read_receipts(spark, _write("px,alipay,1600000010\n"))
    assert rows(r, "pay_id", "pay_type", "ts_s") == [("px", "alipay", 1600000010)]


def test_ad_and_login_readers(spark):
    a = read_ad_clicks(spark, _write("7,9,north,town,1600000000\n"))
    assert rows(a, "user_id", "ad_id", "province", "city") == [(7, 9, "north", "town")]
    lg = read_logins(spark, _write("7,10.0.0.1,fail,1600000000\n"))
    assert rows(lg, "user_id", "ip", "event_type") == [(7, "10.0.0.1", "fail")]
    m = read_marketing(spark, _write("u-1,CLICK,APPLE,1600000000123\n"))
    assert [r.ts.microsecond for r in m.collect()] == [123000]


def test_access_log_parse(spark):
    p = _write("10.0.0.1 - - 17/05/2020:10:05:03 +0000 GET /a/b.html\n"
               "10.0.0.2 - - 17/05/2020:10:05:09 +0000 POST /c\n")
    df = read_access_log(spark, p)
    got = rows(df.selectExpr("ip", "method", "url", "unix_seconds(ts) as s"))
    assert got == [("10.0.0.1", "GET", "/a/b.html", 1589709903), ("10.0.0.2", "POST", "/c", 1589709909)]
    shifted = read_access_log(spark, p, tz="Asia/Shanghai").selectExpr("unix_seconds(ts) as s").collect()
    assert sorted(r.s for r in shifted) == [1589709903 - 8 * 3600, 1589709909 - 8 * 3600]


def test_malformed_rows(spark):
    p = _write("101,5001,77,pv,1600000000\nnot-a-number,1,1,pv,1600000001\n")
    with pytest.raises(Exception):
        read_user_behavior(spark, p).collect()
    assert len(read_user_behavior(spark, p, mode="DROPMALFORMED").collect()) == 1
    bad_log = _write("10.0.0.1 - - 99/99/2020:10:05:03 +0000 GET /a\n10.0.0.1 - - 17/05/2020:10:05:03 +0000 GET /b\n")
    assert rows(read_access_log(spark, bad_log, mode="DROPMALFORMED"), "url") == [("/b",)]


def test_bad_unused_field_fails(spark):
    # the category is not read by these jobs, the city not by any
    p = _write("101,5001,77,pv,1600000000\n101,5001,x7,pv,1600000001\n")
    for columns in (["user_id"], ["behavior", "ts"], ["ts_s", "seq"]):
        with pytest.raises(Exception, match="MALFORMED"):
            read_user_behavior(spark, p).select(*columns).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        run_job(spark, "page_views", [p])["result"].collect()
    for short in ("7,9,north,1600000000\n", "7,9,north,town,c,1600000000\n"):
        with pytest.raises(Exception, match="MALFORMED"):
            read_ad_clicks(spark, _write(short)).select("user_id").collect()
    with pytest.raises(Exception, match="too few fields"):
        read_access_log(spark, _write("10.0.0.1 - - 17/05/2020:10:05:03 +0000 GET\n")).select("ip").collect()


def test_malformed_lines_are_a_branch(spark):
    d = tempfile.mkdtemp(prefix="eventide-bad-")
    good = [f"{i},5001,77,pv,{1600000000 + i}" for i in range(3000)]
    bad = {17: "x,1,1,pv,1600000000", 1500: "1,2,3,pv", 2999: "1,2,3,pv,17e", 2500: "1,2,,pv,1600000000,9"}
    for name, marks in (("a.csv", bad), ("b.csv", {5: "1,2,z,pv,3"})):
        lines = list(good)
        for n, text in marks.items():
            lines[n - 1] = text
        lines[9] = ""                               # an empty line is no row, and counts as a line
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")     # several splits a file
    try:
        res = read_branches(read_user_behavior, spark, d)
        got = sorted((os.path.basename(r.file), r.line, r.reason, r.value) for r in res.malformed.collect())
        assert res.rows.columns == read_user_behavior(spark, d).columns
        assert res.rows.count() == 2 * 2999 - 5
        outs = run_job(spark, "page_views", [d], malformed=True)
        assert outs["malformed"].count() == 5 and sum(r.pv for r in outs["result"].collect()) == 2 * 2999 - 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [("a.csv", 17, "user_id is no bigint: x", bad[17]), ("a.csv", 1500, "5 fields expected, found 4", bad[1500]),
                   ("a.csv", 2500, "5 fields expected, found 6", bad[2500]), ("a.csv", 2999, "ts_s is no bigint: 17e", bad[2999]),
                   ("b.csv", 5, "category_id is no bigint: z", "1,2,z,pv,3")]


def test_malformed_log_lines_are_a_branch(spark):
    p = _write("10.0.0.1 - - 99/99/2020:10:05:03 +0000 GET /a\n10.0.0.1 - - 17/05/2020:10:05:03 +0000 GET /b\nshort line\n")
    res = read_branches(read_access_log, spark, p, tz="UTC")
    assert rows(res.rows, "url") == [("/b",)]
    got = sorted((r.line, r.reason) for r in res.malformed.collect())
    assert got == [(1, "no time: 99/99/2020:10:05:03"), (3, "7 fields expected, found 2")]
    outs = run_job(spark, "top_urls", [p], malformed=True)
    assert outs["malformed"].count() == 2 and {r.url for r in outs["result"].collect()} == {"/b"}


def test_permissive_keeps_corrupt_text(spark):
    p = _write("101,5001,77,pv,1600000000\nnot-a-number,1,1,pv,1600000001\n")
    df = read_user_behavior(spark, p, mode="PERMISSIVE").cache()
    bad = [r for r in df.collect() if r["_corrupt_record"] is not None]
    assert [r["_corrupt_record"] for r in bad] == ["not-a-number,1,1,pv,1600000001"]
    assert bad[0]["user_id"] is None
