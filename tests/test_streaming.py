"""Stream = batch: replay a driver table as files in time order, drain what is left, and compare."""

import datetime
import decimal
import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from eventide.operators import Count, IntAvg, sliding_agg
from eventide.operators.distinct import distinct_per_window
from eventide.operators.joins import interval_join, pair_one_to_one
from eventide.operators.limits import cap_per_key
from eventide.operators.patterns import followed_by, strict_pairs
from eventide.operators.topn import top_n_per_window
from eventide.sources import tables as T
from eventide.streaming import (
    bounded, checkpoint_location, stream_cap_per_key, stream_capped_counts, stream_distinct_per_window,
    stream_followed_by, stream_interval_join, stream_pair_one_to_one, stream_sliding_agg, stream_strict_pairs,
    stream_window_agg, top_n_batch_writer,
)


@pytest.fixture(scope="module")
def replay_dir(spark):
    """The sf0.001 events as 5 parquet files in time order."""
    d = tempfile.mkdtemp(prefix="eventide-replay-")
    pdf = T.events(spark, SF_SMALL).select("event_id", "ts", "user_id", "event_type", "k", "seq") \
        .toPandas().sort_values("ts")
    pdf["ts"] = pdf["ts"].astype("datetime64[us]").dt.tz_localize("UTC")  # parquet instant -> TIMESTAMP
    n = len(pdf)
    for i in range(5):
        p = os.path.join(d, f"part-{i:03d}.parquet")
        pdf.iloc[i * n // 5:(i + 1) * n // 5].to_parquet(p, index=False)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    return d, pdf


def _stream(spark, d):
    schema = spark.read.parquet(d).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


def _batch(spark, d):
    return spark.read.parquet(d)


def _collect(spark, sdf, name):
    """Run the stream over the files that are there: its rows, and its checkpoint."""
    out, ckpt = tempfile.mkdtemp(prefix="eventide-stream-"), checkpoint_location(spark, name)

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
    sdf.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start() \
        .awaitTermination()
    return spark.read.schema(sdf.schema).parquet(out).drop("batch"), ckpt


def test_stream_window_counts_equal_batch(spark, replay_dir):
    d, _ = replay_dir
    s = _stream(spark, d).filter("event_type = 'view'")
    b = _batch(spark, d).filter("event_type = 'view'")
    expect = sliding_agg(b, "1 hour", "20 minutes", [Count("cnt")], keys=["k"])
    got, ckpt = _collect(spark, stream_window_agg(s, "1 hour", [F.count(F.lit(1)).alias("cnt")], keys=["k"],
                                                  slide="20 minutes"), "sw_counts")
    left = bounded.drain_windows(spark, ckpt, "1 hour", [Count("cnt")], ["k"])
    assert left.count() > 0
    assert rows(got.unionByName(left), "k", "window_end", "cnt") == rows(expect, "k", "window_end", "cnt")


@pytest.mark.parametrize("size, slide", [("1 hour", "20 minutes"), ("6 hours", "1 hour"), ("1 hour", "1 hour")])
def test_pane_stream_equals_batch(spark, replay_dir, size, slide):
    d, _ = replay_dir
    aggs = [Count("cnt"), IntAvg("avg", "seq"), Count("n", "k")]
    got, ckpt = _collect(spark, stream_sliding_agg(_stream(spark, d), size, slide, aggs, ["event_type"],
                                                   with_start=True), "panes")
    left = bounded.drain_windows(spark, ckpt, size, aggs, ["event_type"], slide, with_start=True)
    assert left.count() > 0
    expect = sliding_agg(_batch(spark, d), size, slide, aggs, keys=["event_type"], with_start=True)
    assert got.columns == left.columns and set(got.columns) == set(expect.columns)
    assert rows(got.unionByName(left), *got.columns) == rows(expect, *got.columns)


def test_panes_keep_one_state_row_an_event(spark, replay_dir):
    d, pdf = replay_dir
    one = tempfile.mkdtemp(prefix="eventide-one-")
    pdf.iloc[:1].to_parquet(os.path.join(one, "a.parquet"), index=False)
    _, ckpt = _collect(spark, stream_sliding_agg(_stream(spark, one), "1 hour", "10 seconds", [Count("cnt")]), "one")
    held = [df.count() for df in bounded.read_state(spark, ckpt, operator=bounded.AGGREGATE)]
    assert sorted(held) == [0, 1]       # one pane, no window yet; a sliding window would hold 360
    assert bounded.drain_windows(spark, ckpt, "1 hour", [Count("cnt")], slide="10 seconds").count() == 360


def test_stream_distinct_equal_batch(spark, replay_dir):
    d, _ = replay_dir
    got, ckpt = _collect(spark, stream_distinct_per_window(_stream(spark, d), "user_id", "1 hour"), "s_uv")
    expect = distinct_per_window(_batch(spark, d), "user_id", "1 hour")
    got = got.unionByName(bounded.drain_distinct(spark, ckpt))
    assert rows(got, "window_end", "uv") == rows(expect, "window_end", "uv")


def test_stream_top_n_foreach_batch(spark, replay_dir):
    d, _ = replay_dir
    counts = stream_sliding_agg(_stream(spark, d), "1 hour", "30 minutes", [Count("cnt")], ["k"])
    out_dir, ckpt = tempfile.mkdtemp(prefix="eventide-topn-"), checkpoint_location(spark, "topn")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    write = top_n_batch_writer(2, "cnt", "k", sink)
    counts.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start() \
        .awaitTermination()
    write(bounded.drain_windows(spark, ckpt, "1 hour", [Count("cnt")], ["k"], "30 minutes"), bounded.next_batch(spark, ckpt))
    expect = top_n_per_window(sliding_agg(_batch(spark, d), "1 hour", "30 minutes", [Count("cnt")], keys=["k"]),
                              2, "cnt", "k")
    cols = ("window_end", "rank", "k", "cnt")
    assert rows(spark.read.parquet(out_dir), *cols) == rows(expect, *cols)


def test_stream_interval_join_equal_batch(spark, replay_dir):
    d, _ = replay_dir
    s = _stream(spark, d)
    pays = s.filter("event_type = 'purchase'").select("user_id", "ts", "seq")
    clicks = s.filter("event_type = 'click'").select("user_id", "ts", "seq")
    got, _ = _collect(spark, stream_interval_join(pays, clicks, "user_id", "-6 hours", "6 hours"), "s_ij")
    b = _batch(spark, d)
    expect = interval_join(b.filter("event_type = 'purchase'").select("user_id", "ts", "seq"),
                           b.filter("event_type = 'click'").select("user_id", "ts", "seq"),
                           "user_id", "-6 hours", "6 hours")
    assert rows(got, "user_id", "left_seq", "right_seq") == rows(expect, "user_id", "left_seq", "right_seq")


@pytest.mark.parametrize("reset", ["never", "event_day"])
def test_stream_cap_equal_batch(spark, replay_dir, reset):
    d, _ = replay_dir
    s, b = (df.filter("event_type = 'click'") for df in (_stream(spark, d), _batch(spark, d)))
    keys, cap = (["user_id"], 2) if reset == "never" else (["k"], 1)
    got, ckpt = _collect(spark, stream_cap_per_key(s, keys, cap, reset=reset), "s_cap")
    left = bounded.drain_cap_per_key(spark, ckpt, s, keys, cap, reset=reset)
    res = cap_per_key(b, keys, cap, reset=reset)
    kept = got.filter("kind = 'kept'").select(b.columns).unionByName(left.kept)
    assert rows(kept, *b.columns) == rows(res.kept.select(b.columns), *b.columns)
    warned = got.filter("kind = 'warning'").select(*res.warnings.columns).unionByName(left.warnings)
    assert rows(warned, *res.warnings.columns) == rows(res.warnings, *res.warnings.columns)
    if reset == "event_day":
        # a day's numbers are gone once the watermark passed its end
        day = b.agg(F.unix_millis(F.date_trunc("day", F.max("ts")))).first()[0]
        assert bounded._only(bounded.read_state(spark, ckpt, "st")).filter(F.col("key._day") < day).count() == 0


def test_idle_numbers_are_forgotten(spark, replay_dir):
    d, _ = replay_dir
    s = _stream(spark, d).filter("event_type = 'click'")
    kept = []
    for idle in (None, "2 days"):
        _, ckpt = _collect(spark, stream_cap_per_key(s, ["user_id", "k"], 2, idle=idle), "s_idle")
        kept.append(bounded._only(bounded.read_state(spark, ckpt, "st")).count())
    assert kept[1] < kept[0] / 3


@pytest.mark.parametrize("reset", ["never", "event_day"])
def test_capped_counts_are_one_stream(spark, replay_dir, reset):
    d, _ = replay_dir
    s, b = (df.filter("event_type <> 'view'") for df in (_stream(spark, d), _batch(spark, d)))
    got, ckpt = _collect(spark, stream_capped_counts(s, ["user_id"], 3, "event_type", "6 hours", reset=reset, salts=3), "s_q7")
    counts, warned = bounded.drain_capped_counts(spark, ckpt, s, ["user_id"], 3, "event_type", "6 hours", reset=reset)
    res = cap_per_key(b, ["user_id"], 3, reset=reset)
    expect = sliding_agg(res.kept, "6 hours", "6 hours", [Count("cnt")], keys=["event_type"])
    whole = got.filter("window_end IS NOT NULL").select(*counts.columns).unionByName(counts)
    whole = whole.groupBy("event_type", "window_end").agg(F.sum("cnt").alias("cnt"))
    assert rows(whole, "event_type", "window_end", "cnt") == rows(expect, "event_type", "window_end", "cnt")
    seqs = got.filter("passed IS NOT NULL").select("passed.user_id", "passed.seq").unionByName(warned.select("user_id", "seq"))
    assert rows(seqs) == rows(res.warnings, "user_id", "seq")


def test_stream_patterns_equal_batch(spark, replay_dir):
    d, _ = replay_dir
    s, b = _stream(spark, d), _batch(spark, d)
    fail = F.col("event_type") == "error"
    for keys, within in ((["user_id"], "1 day"), ([], "3 hours"), (["user_id"], None)):
        got, ckpt = _collect(spark, stream_strict_pairs(s, fail, fail, within, keys, carry=["k", "event_id"]), "s_x1")
        exp = strict_pairs(b, fail, fail, within, keys, carry=["k", "event_id"])
        left = bounded.drain_strict_pairs(spark, ckpt, s, within, keys, carry=["k", "event_id"])
        assert set(got.columns) == set(exp.columns) == set(left.columns)
        assert rows(got.unionByName(left), *exp.columns) == rows(exp, *exp.columns)
    create, pay = F.col("event_type") == "view", F.col("event_type") == "purchase"
    for within in ("2 days", None):
        got, ckpt = _collect(spark, stream_followed_by(s, create, pay, within, ["user_id"], carry=["k"]), "s_x2")
        exp = followed_by(b, create, pay, within, keys=["user_id"], carry=["k"])
        left = bounded.drain_followed_by(spark, ckpt, s, within, ["user_id"], carry=["k"])
        for kind, part, rest in (("matched", exp.matched, left.matched), ("timeout", exp.timed_out, left.timed_out)):
            whole = got.filter(F.col("kind") == kind).select(*part.columns).unionByName(rest)
            assert rows(whole, *part.columns) == rows(part, *part.columns)
        assert left.timed_out.count() > 0


@pytest.mark.parametrize("timeout", [None, "1 day"])
def test_stream_pairing_equal_batch(spark, replay_dir, timeout):
    d, _ = replay_dir
    s, b = _stream(spark, d), _batch(spark, d)
    pick = lambda df, t: df.filter(F.col("event_type") == t).drop("event_type")
    sides = pick(s, "purchase"), pick(s, "signup")
    got, ckpt = _collect(spark, stream_pair_one_to_one(*sides, "user_id", timeout), f"s_pair_{timeout is None}")
    res = pair_one_to_one(pick(b, "purchase"), pick(b, "signup"), "user_id", timeout=timeout)
    left = bounded.drain_pair_one_to_one(spark, ckpt, *sides, "user_id", timeout)
    for kind in ("matched", "left_only", "right_only"):
        cols = [c for c in getattr(res, kind).columns if c != "reason"]
        whole = got.filter(F.col("kind") == kind).select(*cols).unionByName(getattr(left, kind).select(*cols))
        assert rows(whole, *cols) == rows(getattr(res, kind), *cols)
    over = got.filter("kind = 'overwritten'").select("user_id", F.coalesce("left_seq", "right_seq").alias("seq"))
    assert rows(over.unionByName(left.overwritten.select("user_id", "seq"))) == rows(res.overwritten, "user_id", "seq")


def test_payload_of_every_type(spark):
    day = datetime.date(2024, 5, 17)
    at = datetime.datetime(2024, 5, 17, 1, 2, 3, 456789)
    full = [(1, at, 7, at, day, decimal.Decimal("12.345"), bytearray(b"\x00\xff"), ["a", None], ("x", 5), {"m": 1}, 1.5, True, "é")]
    data = full + [(1, at + datetime.timedelta(hours=1), 8, *[None] * 10), (1, at + datetime.timedelta(days=9), 9, *[None] * 10)]
    schema = ("k int, ts timestamp, seq long, n timestamp_ntz, d date, dec decimal(9, 3), bin binary, arr array<string>, "
              "st struct<p: string, q: int>, mp map<string, int>, dbl double, yes boolean, txt string")
    d = tempfile.mkdtemp(prefix="eventide-types-")
    frame = spark.createDataFrame(data, schema)
    frame.coalesce(1).write.mode("overwrite").parquet(d)
    s = spark.readStream.schema(frame.schema).parquet(d)
    got, ckpt = _collect(spark, stream_cap_per_key(s, ["k"], 9), "s_types")
    left = bounded.drain_cap_per_key(spark, ckpt, s, ["k"], 9).kept
    assert got.count() == 2 and left.count() == 1
    whole = got.select(*frame.columns).unionByName(left.select(*frame.columns))
    assert whole.schema == frame.schema
    assert sorted(map(str, whole.collect())) == sorted(map(str, frame.collect()))


def test_payload_refuses_what_it_cannot_keep():
    from pyspark.sql import types as ST
    from eventide.streaming.payload import stored_type
    with pytest.raises(ValueError):
        stored_type([ST.StructField("a", ST.ArrayType(ST.DateType()))])


def test_drain_then_go_on(spark, replay_dir):
    """Draining only reads: with more files on the same checkpoint the stream goes on as if not drained."""
    d, pdf = replay_dir
    grow = tempfile.mkdtemp(prefix="eventide-grow-")
    out, ckpt = tempfile.mkdtemp(prefix="eventide-grow-out-"), checkpoint_location(spark, "grow")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
    for i, part in enumerate((pdf.iloc[:400], pdf.iloc[400:])):
        part.to_parquet(os.path.join(grow, f"{i}.parquet"), index=False)
        s = _stream(spark, grow).filter("event_type = 'click'")
        stream_cap_per_key(s, ["user_id"], 2).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt) \
            .trigger(availableNow=True).start().awaitTermination()
        left = bounded.drain_cap_per_key(spark, ckpt, s, ["user_id"], 2)
        sink(left.kept.withColumn("kind", F.lit("kept")), bounded.next_batch(spark, ckpt))
        expect = cap_per_key(_batch(spark, grow).filter("event_type = 'click'"), ["user_id"], 2).kept
        got = spark.read.option("mergeSchema", "true").parquet(out).filter("kind = 'kept'")
        assert rows(got, "user_id", "seq") == rows(expect, "user_id", "seq")


def test_one_key_replays_in_linear_time(spark):
    spent = []
    for n in (8_000, 32_000):
        d = tempfile.mkdtemp(prefix="eventide-hot-")
        base = spark.range(n).select(F.lit(1).alias("k"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")).alias("ts"),
                                     F.col("id").alias("seq"))
        for i in range(4):
            part = base.filter(F.floor(F.col("id") * 4 / n) == i).coalesce(1)
            part.write.mode("append").parquet(d)
        s = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(d)
        start = time.time()
        got, ckpt = _collect(spark, stream_cap_per_key(s, ["k"], 10 * n), "s_hot")
        spent.append(time.time() - start)
        assert got.count() + bounded.drain_cap_per_key(spark, ckpt, s, ["k"], 10 * n).kept.count() == n
    assert spent[1] < 8 * spent[0]


def test_branch_writer_splits_kinds(spark, replay_dir):
    from eventide.streaming import start_branches
    d, _ = replay_dir
    s = _stream(spark, d).filter("event_type = 'click'")
    out, ckpt = tempfile.mkdtemp(prefix="eventide-branches-"), checkpoint_location(spark, "branches")
    paths = {"kept": os.path.join(out, "kept"), "warning": os.path.join(out, "warning")}
    start_branches(stream_cap_per_key(s, ["user_id"], 2), paths, ckpt, trigger={"availableNow": True}).awaitTermination()
    res = cap_per_key(_batch(spark, d).filter("event_type = 'click'"), ["user_id"], 2)
    left = bounded.drain_cap_per_key(spark, ckpt, s, ["user_id"], 2)
    for path, whole, rest in ((paths["warning"], res.warnings, left.warnings), (paths["kept"], res.kept, left.kept)):
        got = spark.read.parquet(path).select("user_id", "seq").unionByName(rest.select("user_id", "seq"))
        assert rows(got) == rows(whole, "user_id", "seq")


@pytest.mark.parametrize("size, parts", [("1 hour", 16), ("40 days", 16), ("1 day", 1)])
def test_stream_running_distinct_equal_batch(spark, replay_dir, size, parts):
    from eventide.operators.distinct import running_distinct
    from eventide.streaming import running_counts, stream_first_sightings
    d, _ = replay_dir
    s = _stream(spark, d).filter("event_type = 'view'")
    out, ckpt = tempfile.mkdtemp(prefix="eventide-run-"), checkpoint_location(spark, "s_run")
    firsts = {}

    def sink(batch, batch_id):
        # every batch twice, as after a failure between its write and its commit
        for _ in range(2):
            running_counts(batch, batch_id, f"{ckpt}/carried").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        firsts[batch_id] = batch.select("window_end", "part").distinct().count()
    stream_first_sightings(s, "user_id", size, parts=parts).writeStream.foreachBatch(sink) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    sink(bounded.drain_first_sightings(spark, ckpt), bounded.next_batch(spark, ckpt))
    exp = running_distinct(_batch(spark, d).filter("event_type = 'view'"), "user_id", size)
    got = spark.read.parquet(out)
    assert rows(got, "seq", "window_end", "uv") == rows(exp, "seq", "window_end", "uv")
    if size == "40 days":
        assert max(firsts.values()) > 1         # one window, many keys


def test_bitmap_store_of_a_stream(spark, replay_dir):
    from eventide.operators.distinct import bitmap_distinct_per_window
    from eventide.streaming import bitmap_writer, compact_bitmaps, store_counts
    d, _ = replay_dir
    store, ckpt = tempfile.mkdtemp(prefix="eventide-bitmaps-"), checkpoint_location(spark, "bitmaps")
    write = bitmap_writer(store, "user_id", "1 day", ["event_type"])
    kept = []

    def sink(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            assert compact_bitmaps(spark, store, ["event_type"]) == 2
        kept.append(batch_id)
        write(batch, batch_id)                  # replayed, also after the compaction
    _stream(spark, d).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True) \
        .start().awaitTermination()
    assert len(kept) == 5
    expect = bitmap_distinct_per_window(_batch(spark, d), "user_id", "1 day", ["event_type"])
    cols = ("event_type", "window_end", "uv")
    assert rows(store_counts(spark, store, ["event_type"]), *cols) == rows(expect, *cols)
    assert compact_bitmaps(spark, store, ["event_type"]) == 4 == compact_bitmaps(spark, store, ["event_type"])
    assert rows(store_counts(spark, store, ["event_type"]), *cols) == rows(expect, *cols)
    assert compact_bitmaps(spark, tempfile.mkdtemp()) is None


def test_late_rows_fire_whole_rankings_again(spark):
    """The lists after the last late row are those of ``top_urls`` with the same delay and lateness."""
    from eventide.plans import jobs
    from eventide.streaming import newest_rankings, ranking_writer
    from helpers import T0

    base = T0 - T0 % 60
    d = tempfile.mkdtemp(prefix="eventide-refire-")
    parts = [
        [("/a", 1), ("/b", 2), ("/a", 20), ("/c", 21)],
        [("/b", 40), ("/c", 5), ("/c", 30)],                    # 35 s late, within 5 s + 60 s
        [("/b", 70), ("/b", 12), ("/d", 66), ("/d", 67)],       # 58 s late
        # a watermark rejects late rows from the second batch after the one that set it
        [("/a", 300), ("/a", 301)], [("/a", 302)], [("/c", 10), ("/b", 299)],   # far too late; in time
    ]
    seq = 0
    for i, part in enumerate(parts):
        pdf = pd.DataFrame([(u, base + s, seq + j) for j, (u, s) in enumerate(part)], columns=["url", "ts_s", "seq"])
        seq += len(part)
        pdf["ts"] = pd.to_datetime(pdf["ts_s"], unit="s", utc=True).astype("datetime64[us, UTC]")
        p = os.path.join(d, f"part-{i}.parquet")
        pdf.to_parquet(p, index=False)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    counts = stream_window_agg(_stream(spark, d), "60 seconds", [F.count(F.lit(1)).alias("cnt")], keys=["url"],
                               slide="20 seconds", delay="65 seconds")
    path = tempfile.mkdtemp(prefix="eventide-refire-out-")
    write = ranking_writer(path, 2, "cnt", "url", span="1 minute")

    def sink(batch, batch_id):
        batch.persist()
        for _ in range(2 if batch_id == 1 else 1):              # one replay
            write(batch, batch_id)
        batch.unpersist()
    counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_location(spark, "refire")) \
        .trigger(availableNow=True).start().awaitTermination()
    lists = spark.read.parquet(f"{path}/rankings")
    assert lists.groupBy("window_end").agg(F.count_distinct("_version").alias("n")).filter("n > 1").count() > 0
    on_time = _batch(spark, d).filter(~((F.col("url") == "/c") & (F.col("ts_s") == base + 10)))
    expect = jobs.top_urls(on_time, 2, "60 seconds", "20 seconds")
    cols = ("window_end", "rank", "url", "cnt")
    assert rows(newest_rankings(spark, path), *cols) == rows(expect, *cols)


def test_update_mode_versions_resolve_to_final_counts(spark):
    """Early results that late rows (within the allowed lateness) update: the newest
    version per (window, url) equals the batch count, and so does its top-N."""
    from eventide.plans import jobs
    from eventide.streaming import resolve_latest, versioned_writer
    from helpers import T0

    d = tempfile.mkdtemp(prefix="eventide-late-")
    batches = [
        [("/a", T0 + 1, 0), ("/b", T0 + 2, 1), ("/a", T0 + 20, 2)],
        [("/b", T0 + 40, 3), ("/a", T0 + 5, 4)],            # 35 s late, within 5 s + 60 s
        [("/b", T0 + 70, 5), ("/b", T0 + 12, 6)],           # 58 s late
    ]
    for i, b in enumerate(batches):
        pdf = pd.DataFrame(b, columns=["url", "ts_s", "seq"])
        pdf["ts"] = pd.to_datetime(pdf["ts_s"], unit="s", utc=True).astype("datetime64[us, UTC]")
        p = os.path.join(d, f"part-{i}.parquet")
        pdf.to_parquet(p, index=False)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    schema = spark.read.parquet(d).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    counts = stream_window_agg(s, "60 seconds", [F.count(F.lit(1)).alias("cnt")], keys=["url"],
                               slide="20 seconds", delay="65 seconds")
    out = tempfile.mkdtemp(prefix="eventide-versions-")
    q = (counts.writeStream.outputMode("update").foreachBatch(versioned_writer(out))
         .option("checkpointLocation", checkpoint_location(spark, "versions")).trigger(availableNow=True).start())
    q.awaitTermination()
    versions = spark.read.parquet(out).groupBy("url", "window_end").count()
    assert versions.filter("count > 1").count() > 0  # windows were emitted early and then updated
    latest = resolve_latest(spark, out, ["url", "window_end"])
    batch = spark.read.parquet(d)
    expect = sliding_agg(batch, "60 seconds", "20 seconds", [Count("cnt")], keys=["url"])
    assert rows(latest, "url", "window_end", "cnt") == rows(expect, "url", "window_end", "cnt")
    ranked = top_n_per_window(latest, 1, "cnt", "url")
    assert rows(ranked, "window_end", "url", "cnt") == \
        rows(jobs.top_urls(batch, 1, "60 seconds", "20 seconds"), "window_end", "url", "cnt")
