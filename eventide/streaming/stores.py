"""Tables that a stream keeps up to date, one version a micro-batch.

Every writer puts the rows of micro-batch ``id`` in a folder of their own and overwrites it when
the batch is replayed, so a table is the same whether a batch ran once or twice.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import interval_millis
from eventide.operators.distinct import bitmap_distinct_per_window, merge_bitmaps, running_flags
from eventide.operators.topn import latest_per_key, top_n_per_window


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the folders ``path/<prefix><number>`` whose write was committed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(prefix):]) for n in names
                  if n.startswith(prefix) and exists(spark, f"{path}/{n}/_SUCCESS"))


# ---- A8: running distinct counts ------------------------------------------------------

def running_counts(batch: DataFrame, batch_id: int, folder: str, sub="1 minute", out: str = "uv") -> DataFrame:
    """Per event of a micro-batch of ``stream_first_sightings``: seq, window_end and the distinct
    values of its window so far.

    The rows of a batch all come after those of the batches before (the watermark lies between
    them), so the count is the window's total before the batch plus a prefix sum in it.  Totals
    of open windows are one small table a batch under ``folder``; a replayed batch starts from the
    totals of the one before it.
    """
    spark = batch.sparkSession
    before = spark.createDataFrame([], "window_end long, total long")
    if exists(spark, f"{folder}/batch={batch_id - 1}/_SUCCESS"):
        before = spark.read.schema(before.schema).parquet(f"{folder}/batch={batch_id - 1}")
    carried = before.select(F.col("window_end").alias("_w"), "total")
    now = batch.groupBy("window_end").agg(F.sum("first").alias("new"), F.max("us").alias("last"))
    both = now.join(carried, F.col("window_end") == F.col("_w"), "full").select(
        F.coalesce("window_end", "_w").alias("window_end"),
        (F.coalesce("new", F.lit(0)) + F.coalesce("total", F.lit(0))).alias("total"))
    # windows that ended before the last released row are closed
    closed = batch.agg(F.floor(F.max("us") / 1000).alias("passed"))
    both = both.join(F.broadcast(closed), F.coalesce(F.col("window_end") > F.col("passed"), F.lit(True)))
    both.select("window_end", "total").write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    sub_us = interval_millis(sub) * 1000
    rows = batch.withColumn("_sub", F.col("us") - F.pmod("us", F.lit(sub_us)))
    counted = running_flags(rows, ["window_end"], "_sub", "first", ["us", "seq"], "_n")
    return counted.join(carried, F.col("window_end") == F.col("_w"), "left").select(
        "seq", "window_end", (F.col("_n") + F.coalesce("total", F.lit(0))).alias(out))


# ---- S11 / A7: the bitmap store -------------------------------------------------------

def bitmap_writer(store: str, col: str, size, keys=(), ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the micro-batch's bitmaps per (keys, window, bucket) become
    ``store/delta/batch=<id>``.  The stream needs no state and no watermark: bitmaps merge by OR,
    so late rows and replays change nothing that is already there."""
    def run(batch: DataFrame, batch_id: int) -> None:
        bitmaps = bitmap_distinct_per_window(batch, col, size, keys, ts, keep_bitmaps=True)
        bitmaps.write.mode("overwrite").parquet(f"{store}/delta/batch={batch_id}")
    return run


def stored_bitmaps(spark: SparkSession, store: str) -> DataFrame | None:
    """The newest compacted version and the deltas after it (None for an empty store)."""
    versions, batches = _numbers(spark, f"{store}/base", "version="), _numbers(spark, f"{store}/delta", "batch=")
    last = versions[-1] if versions else -1
    paths = [f"{store}/base/version={last}"] if versions else []
    paths += [f"{store}/delta/batch={b}" for b in batches if b > last]
    return spark.read.parquet(*paths) if paths else None


def compact_bitmaps(spark: SparkSession, store: str, keys=()) -> int | None:
    """OR-merge the store into one version, named after its last batch; returns that number.

    Older files stay until the caller removes them: readers take the newest version only, so a
    compaction that is lost half-way, or run twice, changes no result.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bitmaps, batches = stored_bitmaps(spark, store), _numbers(spark, f"{store}/delta", "batch=")
    versions = _numbers(spark, f"{store}/base", "version=")
    if not batches or (versions and versions[-1] >= batches[-1]):
        return versions[-1] if versions else None
    merged = bitmaps.groupBy(*keys, "window_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    merged.write.mode("overwrite").parquet(f"{store}/base/version={batches[-1]}")
    return batches[-1]


def store_counts(spark: SparkSession, store: str, keys=(), out: str = "uv") -> DataFrame:
    """Distinct counts per (keys, window) of everything in the store."""
    return merge_bitmaps(stored_bitmaps(spark, store), keys, out)


# ---- E6 / E11 / T2: rankings that late rows fire again --------------------------------

def ranking_writer(path: str, n: int, metric: str, key: str, span="1 hour") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for an update-mode stream of counts per (window, key).

    Each micro-batch brings the counts that changed.  They become the newest version of their
    (window, key); then every window that changed is ranked as a whole, from the newest count of
    all its keys, and its complete list becomes the newest version of the window.  So a window is
    reported early and again whenever late rows change it, as the reference re-fires it.  Counts
    are partitioned by spans of window ends; only the spans of changed windows are read again.
    """
    span_ms = interval_millis(span)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spanned = batch.withColumn("_span", F.col("window_end") - F.pmod("window_end", F.lit(span_ms)))
        spanned.write.mode("overwrite").partitionBy("_span").parquet(f"{path}/counts/_version={batch_id}")
        changed = spark.read.schema(spanned.schema).parquet(f"{path}/counts/_version={batch_id}")
        changed = changed.select("_span", "window_end").distinct()
        counts = _versions(spark, f"{path}/counts", batch_id, spanned.schema)
        counts = counts.join(changed, ["_span", "window_end"], "left_semi").drop("_span")
        newest = latest_per_key(counts, ["window_end", key], "_version").drop("_version")
        ranked = top_n_per_window(newest, n, metric, key)
        ranked.write.mode("overwrite").parquet(f"{path}/rankings/_version={batch_id}")
    return run


def _versions(spark: SparkSession, path: str, upto: int | None, schema) -> DataFrame:
    """All committed versions up to a batch, with their number."""
    known = [v for v in _numbers(spark, path, "_version=") if upto is None or v <= upto]
    frames = spark.read.option("basePath", path).schema(schema.add("_version", "long") if schema else None) if schema \
        else spark.read.option("basePath", path)
    return frames.parquet(*[f"{path}/_version={v}" for v in known])


def newest_rankings(spark: SparkSession, path: str) -> DataFrame:
    """The last complete list of every window written by ``ranking_writer``."""
    lists = _versions(spark, f"{path}/rankings", None, None)
    newest = lists.groupBy("window_end").agg(F.max("_version").alias("_version"))
    return lists.join(newest, ["window_end", "_version"]).drop("_version")
