"""Arrival order of text inputs of several files and splits."""

import os

import pytest

from conftest import rows
from eventide.plans.run import run_job
from eventide.sources import read_lines


def _log(path, minute, n, hour):
    with open(path, "w") as f:
        for i in range(n):
            f.write(f"10.0.0.1 - - 17/05/2020:{hour}:{minute:02d}:{i % 60:02d} +0000 GET /p{i % 7}\n")


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "256"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _texts(spark, path, **kw):
    return [r.value for r in read_lines(spark, path, **kw).orderBy("seq").collect()]


def test_order_of_files_and_splits(spark, tmp_path, small_splits):
    want = []
    for name, n in (("a.txt", 40), ("b b.txt", 700), ("c.txt", 0), ("d.txt", 3), ("e.txt", 300)):
        lines = [f"{name} {i} {'x' * (i % 30)}" for i in range(n)]
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
        want += lines
    df = read_lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    assert _texts(spark, str(tmp_path)) == want
    assert df.select("seq").distinct().count() == len(want)


def test_order_by_modification_time(spark, tmp_path):
    for k, name in enumerate(("z.txt", "a.txt", "m.txt")):
        (tmp_path / name).write_text(f"{k}\n")
        os.utime(tmp_path / name, (1_600_000_000 + k, 1_600_000_000 + k))
    assert _texts(spark, str(tmp_path), files="modified") == ["0", "1", "2"]
    assert _texts(spark, str(tmp_path)) == ["1", "2", "0"]


def test_unequal_files_lose_no_windows(spark, tmp_path, small_splits):
    many, one = tmp_path / "many", tmp_path / "one"
    many.mkdir()
    one.mkdir()
    _log(many / "a-1200.log", 0, 100, 12)
    _log(many / "b-1300.log", 0, 400, 13)
    whole = (many / "a-1200.log").read_text() + (many / "b-1300.log").read_text()
    (one / "all.log").write_text(whole)
    got = rows(run_job(spark, "top_urls", [str(many)])["result"])
    assert got == rows(run_job(spark, "top_urls", [str(one)])["result"])
    ends = [r[0] for r in got]
    assert max(ends) - min(ends) > 3_600_000      # windows of both hours
