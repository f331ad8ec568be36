"""Streaming windows (E2-E6, A5, A6, T1/T2 on streams).

Append mode: a window is emitted once, when the watermark passes its end.  The
watermark delay is the reference's out-of-orderness bound (0 for its ascending
timestamps, 5 s for the access log); its allowed lateness of 60 s is modelled by
adding it to the delay (the window waits for late rows instead of re-firing).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import interval_millis
from eventide.operators.aggs import finish_exprs, merge_exprs, partial_exprs
from eventide.operators.topn import top_n_per_window
from eventide.session import checkpoint_dir


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh checkpoint folder for a streaming query under the shared checkpoint dir."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def _window(ts: str, size, slide):
    size = str(size)
    return F.window(ts, size, str(slide)) if slide and str(slide) != size else F.window(ts, size)


def stream_window_agg(df: DataFrame, size, aggs: Sequence[Column], keys=(), slide=None,
                      ts: str = "ts", delay="0 seconds", with_start: bool = False) -> DataFrame:
    """Windowed aggregate of a stream -> keys, [window_start], window_end (epoch ms), aggs.

    ``aggs`` are aggregate Columns (``F.count(F.lit(1)).alias("cnt")`` ...).  Spark keeps
    one partial state row per (keys, window) and emits a window when the watermark
    (max event time - ``delay``) passes its end."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = (df.withWatermark(ts, str(delay))
             .groupBy(_window(ts, size, slide).alias("w"), *keys)
             .agg(*aggs))
    cols = [*keys]
    if with_start:
        cols.append(F.unix_millis("w.start").alias("window_start"))
    return out.select(*cols, F.unix_millis("w.end").alias("window_end"),
                      *[c for c in out.columns if c not in keys and c != "w"])


def stream_sliding_agg(df: DataFrame, size, slide, aggs, keys=(), ts: str = "ts", delay="0 seconds",
                       with_start: bool = False) -> DataFrame:
    """Sliding windows of a stream by panes (E5) -> keys, [window_start], window_end, aggregates.

    Two chained aggregates: rows into tumbling panes of ``slide``, closed panes into the windows
    they belong to (their event time handed on by ``window_time``).  A row is one state update; only
    pane results are copied to ``size / slide`` windows.  ``aggs`` are the mergeable specs of
    ``operators.aggs``; ``size`` must be a multiple of ``slide``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if interval_millis(size) % interval_millis(slide):
        raise ValueError("size must be a multiple of slide")
    if interval_millis(size) == interval_millis(slide):
        done = df.withWatermark(ts, str(delay)).groupBy(F.window(ts, str(size)).alias("w"), *keys).agg(*partial_exprs(aggs))
    else:
        panes = (df.withWatermark(ts, str(delay)).groupBy(F.window(ts, str(slide)).alias("pane"), *keys)
                 .agg(*partial_exprs(aggs)))
        done = panes.groupBy(F.window(F.window_time("pane"), str(size), str(slide)).alias("w"), *keys).agg(*merge_exprs(aggs))
    start = [F.unix_millis("w.start").alias("window_start")] if with_start else []
    return done.select(*keys, *start, F.unix_millis("w.end").alias("window_end"), *finish_exprs(aggs))


def stream_distinct_per_window(df: DataFrame, col: str, size, ts: str = "ts", delay="0 seconds",
                               out: str = "uv") -> DataFrame:
    """Exact distinct count per tumbling window of a stream: ``count_distinct`` is not
    supported on streams, so rows are deduplicated per (window, value) (state evicted by
    the watermark) and then counted."""
    w = df.withWatermark(ts, str(delay)).withColumn("w", F.window(ts, str(size)))
    return (w.dropDuplicates(["w", col])
             .groupBy("w").agg(F.count(F.lit(1)).alias(out))
             .select(F.unix_millis("w.end").alias("window_end"), out))


def stream_approx_distinct(df: DataFrame, col: str, size, ts: str = "ts", delay="0 seconds",
                           out: str = "uv") -> DataFrame:
    """Approximate distinct count per tumbling window (HLL++ state per window)."""
    return stream_window_agg(df, size, [F.approx_count_distinct(col).alias(out)], ts=ts, delay=delay)


def top_n_batch_writer(n: int, metric: str, key: str, sink: Callable[[DataFrame, int], None],
                       window_end: str = "window_end") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for an append-mode windowed count stream: every window
    of a micro-batch is complete (all its keys close together), so the batch top-N is
    the final top-N.  ``sink(ranked_df, batch_id)`` writes the result (idempotently per
    batch id for exactly-once)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(top_n_per_window(batch, n, metric, key, window_end=window_end), batch_id)
    return run
