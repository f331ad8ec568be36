"""The reference's jobs as Structured Streaming queries.

Each job has the readers of its inputs, a builder of the stream, a function that splits and
shapes a micro-batch into the output branches of the batch job (same names, same columns), and a
function that drains what the stopped query's state still holds (``streaming.bounded``) into the
same branches.  Ranking jobs rank per micro-batch: every window of an append-mode batch is
complete.  Watermark delays follow the reference: 0 for its ascending timestamps, 5 s for the
access log, plus the allowed lateness of 60 s for the hot-URL windows.

Streams cannot number rows in arrival order; there ``seq`` is a hash of the file and the row.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide import sources as S
from eventide.functions.text import URL_FOOTER, URL_LABEL, format_ranking
from eventide.operators.aggs import Agg, Count, IntAvg
from eventide.operators.limits import BLACKLIST_MSG
from eventide.operators.topn import top_n_per_window
from eventide.plans import jobs
from eventide.streaming import bounded
from eventide.streaming.joins import stream_interval_join
from eventide.streaming.payload import payload_fields, unpack
from eventide.streaming.processors import (
    stream_capped_counts, stream_first_sightings, stream_followed_by, stream_pair_one_to_one, stream_strict_pairs,
)
from eventide.streaming.stores import running_counts
from eventide.streaming.windows import stream_distinct_per_window, stream_sliding_agg

Branches = dict[str, DataFrame]


class Place(NamedTuple):
    """A micro-batch's number, and the folder for what is carried from batch to batch."""
    batch_id: int
    folder: str


class StreamJob(NamedTuple):
    readers: list[Callable]
    stream: Callable[..., DataFrame]            # of the inputs
    branches: Callable[..., Branches]           # of a micro-batch, its place and the inputs
    drain: Callable[..., Branches]              # of the session, the checkpoint, the place and the inputs


def _windows(reader, rows, size, aggs: list[Agg], shape, keys=(), slide=None, delay="0 seconds",
             with_start=False) -> StreamJob:
    """A job of one windowed aggregate; open windows are shaped like those of a micro-batch."""
    def stream(df):
        return stream_sliding_agg(rows(df), size, slide or size, aggs, keys, delay=delay, with_start=with_start)

    def drain(spark, checkpoint, at, df):
        return {"result": shape(bounded.drain_windows(spark, checkpoint, size, aggs, keys, slide, with_start))}
    return StreamJob([reader], stream, lambda batch, at, df: {"result": shape(batch)}, drain)


def _views(b):
    return b.filter(F.col("behavior") == "pv")


def hot_items(n=3, size="1 hour", slide="5 minutes", metric="count", report=False) -> StreamJob:
    def shape(counts):
        ranked = top_n_per_window(counts, n, "cnt", "item_id")
        return (format_ranking(ranked, "item_id", "cnt") if report
                else ranked.select("window_end", "rank", "item_id", "cnt"))
    agg = Count("cnt") if metric == "count" else IntAvg("cnt", "ts_s")
    return _windows(S.read_user_behavior, _views, size, [agg], shape, ["item_id"], slide)


def page_views(size="1 hour") -> StreamJob:
    return _windows(S.read_user_behavior, _views, size, [Count("pv")], lambda w: w)


def unique_visitors(size="1 hour") -> StreamJob:
    return StreamJob([S.read_user_behavior], lambda b: stream_distinct_per_window(_views(b), "user_id", size),
                     lambda batch, at, b: {"result": batch},
                     lambda spark, checkpoint, at, b: {"result": bounded.drain_distinct(spark, checkpoint)})


def unique_visitors_bitmap(size="1 hour", parts=16) -> StreamJob:
    def branches(batch, at, b):
        return {"result": running_counts(batch, at.batch_id, at.folder)}

    def drain(spark, checkpoint, at, b):
        return branches(bounded.drain_first_sightings(spark, checkpoint), at, b)
    return StreamJob([S.read_user_behavior], lambda b: stream_first_sightings(_views(b), "user_id", size, parts=parts),
                     branches, drain)


def _text_bounds(windows):
    return windows.withColumns({c: F.col(c).cast("string") for c in ("window_start", "window_end")})


def marketing(keys=(), size="1 hour", slide="10 seconds", exclude="UNINSTALL") -> StreamJob:
    return _windows(S.read_marketing, lambda m: m.filter(F.col("behavior") != exclude), size, [Count("cnt")],
                    _text_bounds, keys, slide, with_start=True)


def ad_blacklist(cap=100, size="1 hour", keys=("user_id", "ad_id"), reset="never") -> StreamJob:
    keys = list(keys)

    def branches(batch, at, clicks):
        # the salted parts of a window leave in one micro-batch
        counts = batch.filter(F.col("window_end").isNotNull()).groupBy("province", "window_end").agg(F.sum("cnt").alias("cnt"))
        warned = batch.filter(F.col("window_end").isNull()).select(*unpack("passed", payload_fields(clicks.schema, ())))
        return {"province_counts": counts, "warnings": warned.select(*keys, "seq", F.lit(BLACKLIST_MSG).alias("msg"))}

    def drain(spark, checkpoint, at, clicks):
        counts, warnings = bounded.drain_capped_counts(spark, checkpoint, clicks, keys, cap, "province", size, reset=reset)
        return {"province_counts": counts, "warnings": warnings.select(*keys, "seq", "msg")}
    return StreamJob([S.read_ad_clicks], lambda a: stream_capped_counts(a, keys, cap, "province", size, reset=reset),
                     branches, drain)


def login_failures(within="2 seconds", keyed=False) -> StreamJob:
    keys, carry = (["user_id"], []) if keyed else ([], ["user_id"])
    fail = F.col("event_type") == "fail"
    return StreamJob(
        [S.read_logins], lambda lg: stream_strict_pairs(lg, fail, fail, within, keys, carry=carry),
        lambda batch, at, lg: {"result": jobs.login_report(batch, keyed)},
        lambda spark, checkpoint, at, lg: {"result": jobs.login_report(
            bounded.drain_strict_pairs(spark, checkpoint, lg, within, keys, carry=carry), keyed)})


def order_timeout(within="15 minutes") -> StreamJob:
    def stream(o):
        return stream_followed_by(o, F.col("pay_status") == "create", F.col("pay_status") == "pay", within, ["order_id"])

    def drain(spark, checkpoint, at, o):
        res = bounded.drain_followed_by(spark, checkpoint, o, within, ["order_id"])
        return jobs.order_report(res.matched, res.timed_out)._asdict()
    return StreamJob([S.read_orders], stream, lambda batch, at, o: jobs.order_report(
        batch.filter("kind = 'matched'"), batch.filter("kind = 'timeout'"))._asdict(), drain)


def _pays(o):
    return o.filter(F.col("pay_status") == "pay").select("pay_id", "ts", "seq", "order_id")


def receipt_match(timeout=None) -> StreamJob:
    def sides(o, r):
        return _pays(o), r.drop("ts_s")

    def stream(o, r):
        return stream_pair_one_to_one(*sides(o, r), "pay_id", timeout, left_prefix="pay_", right_prefix="receipt_")

    def branches(batch, at, o, r):
        pay = [c for c in batch.columns if c.startswith("pay_") and c != "pay_id"]
        # pay_type belongs to the receipt and comes as receipt_pay_type
        receipt = [c for c in batch.columns if c.startswith("receipt_")]
        over = batch.filter("kind = 'overwritten'")
        late = F.lit("timeout").alias("reason")
        return {
            "matched": batch.filter("kind = 'matched'").select("pay_id", *pay, *receipt),
            "left_only": batch.filter("kind = 'left_only'").select("pay_id", *pay, late),
            "right_only": batch.filter("kind = 'right_only'").select("pay_id", *receipt, late),
            "overwritten": over.select("pay_id", F.when(F.col("pay_ts").isNotNull(), "left").otherwise("right").alias("side"),
                                       F.coalesce("pay_ts", "receipt_ts").alias("ts"),
                                       F.coalesce("pay_seq", "receipt_seq").alias("seq")),
        }

    def drain(spark, checkpoint, at, o, r):
        return bounded.drain_pair_one_to_one(spark, checkpoint, *sides(o, r), "pay_id", timeout,
                                             left_prefix="pay_", right_prefix="receipt_")._asdict()
    return StreamJob([S.read_orders, S.read_receipts], stream, branches, drain)


def receipt_interval_join(lower="-15 seconds", upper="15 seconds") -> StreamJob:
    # an inner join emits a pair as soon as both rows are there: nothing to drain
    return StreamJob(
        [S.read_orders, S.read_receipts], lambda o, r: stream_interval_join(
            _pays(o), r.drop("ts_s"), "pay_id", lower, upper, left_prefix="pay_", right_prefix="receipt_"),
        lambda batch, at, o, r: {"result": batch}, lambda spark, checkpoint, at, o, r: {})


def top_urls(n=5, size="10 minutes", slide="5 seconds", delay="65 seconds", report=False) -> StreamJob:
    def shape(counts):
        ranked = top_n_per_window(counts, n, "cnt", "url")
        return (format_ranking(ranked, "url", "cnt", key_label=URL_LABEL, footer=URL_FOOTER) if report
                else ranked.select("window_end", "rank", "url", "cnt"))
    return _windows(S.read_access_log, lambda log: log, size, [Count("cnt")], shape, ["url"], slide, delay)


JOBS: dict[str, Callable[[], StreamJob]] = {
    "hot_items": hot_items,
    "hot_items_report": lambda: hot_items(report=True),
    "page_views": page_views,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "marketing_total": marketing,
    "marketing_by_channel": lambda: marketing(["behavior", "channel"]),
    "ad_blacklist": ad_blacklist,
    "login_failures": login_failures,
    "order_timeout": order_timeout,
    "receipt_match": receipt_match,
    "receipt_interval_join": receipt_interval_join,
    "top_urls": top_urls,
}


def _job(spark: SparkSession, name: str, inputs: list[str], job: StreamJob | None) -> tuple[StreamJob, list[DataFrame]]:
    job = job or JOBS[name]()
    if len(inputs) != len(job.readers):
        raise SystemExit(f"{name} needs {len(job.readers)} input(s)")
    return job, [r(spark, p, stream=True) for r, p in zip(job.readers, inputs)]


def _write(branches: Branches, output: str, batch_id: int) -> None:
    for branch, df in branches.items():
        df.write.mode("overwrite").parquet(os.path.join(output, branch, f"batch={batch_id}"))


def start(spark: SparkSession, name: str, inputs: list[str], output: str, checkpoint: str,
          available_now: bool = True, job: StreamJob | None = None):
    """Start a streaming job; each branch goes to ``output/<branch>/batch=<id>`` as Parquet (a
    replayed batch overwrites its own rows).  ``job``: the named job with other parameters."""
    job, frames = _job(spark, name, inputs, job)
    carried = os.path.join(checkpoint, "carried")

    def sink(batch, batch_id):
        batch.persist()
        try:
            _write(job.branches(batch, Place(batch_id, carried), *frames), output, batch_id)
        finally:
            batch.unpersist()
    w = job.stream(*frames).writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.foreachBatch(sink).start()


def finish(spark: SparkSession, name: str, inputs: list[str], output: str, checkpoint: str,
           job: StreamJob | None = None) -> None:
    """Write what a stopped job's state still holds, as the batch that would come next.

    The state is only read.  If the job is started again on the same checkpoint, its next batch
    overwrites these rows and its operators give them again in their time.
    """
    job, frames = _job(spark, name, inputs, job)
    at = Place(bounded.next_batch(spark, checkpoint), os.path.join(checkpoint, "carried"))
    _write(job.drain(spark, checkpoint, at, *frames), output, at.batch_id)
