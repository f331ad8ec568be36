"""Late data in batch form.

A stream with a bounded out-of-orderness watermark sees, at each row, the
watermark ``max(event time of rows that arrived earlier) - delay``.  Stateful
operators drop rows older than the watermark (E7); a window with allowed
lateness ``L`` still accepts a row while ``window_end - 1 ms + L > watermark``
(E6, the reference's rule), so a late row can miss some of its sliding windows
and still count in the later ones.

``watermark_at_arrival`` computes that watermark for every row of a batch
without a driver loop or a single task over all rows: a two-level prefix
maximum.  Rows are grouped in blocks of the arrival order; per block the maximum
event time is an aggregate, the exclusive prefix over the (few) block maxima is a
window over one row per block, and the running maximum inside a block is a
window partitioned by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import interval_millis, millis

ARRIVAL_BLOCK = 1 << 20


def watermark_at_arrival(df: DataFrame, ts: str = "ts", arrival: str = "seq", delay="0 seconds",
                         out: str = "wm_ms", block: int = ARRIVAL_BLOCK) -> DataFrame:
    """Add ``out`` = max event time (epoch ms) of rows with a smaller ``arrival`` value,
    minus ``delay``; null for the first row.  Rows without an arrival value are dropped.

    One shuffle of the rows (by arrival block); the block maxima come from the same
    partitions, and only one row per block goes through the un-partitioned prefix."""
    d_ms = interval_millis(delay)
    a = F.col(arrival)
    staged = (df.filter(a.isNotNull())
                .withColumn("_ab", F.coalesce(a - F.pmod(a, F.lit(block)), F.lit(0)))
                .withColumn("_tm", millis(ts)))
    inside = F.max("_tm").over(Window.partitionBy("_ab").orderBy(a).rowsBetween(Window.unboundedPreceding, -1))
    windowed = staged.withColumn("_im", inside)
    per_block = windowed.groupBy("_ab").agg(F.max("_tm").alias("_bm"))
    # one row per arrival block: the un-partitioned window moves only these to one task
    prefix = per_block.select("_ab", F.max("_bm").over(
        Window.orderBy("_ab").rowsBetween(Window.unboundedPreceding, -1)).alias("_pm"))
    return (windowed.join(prefix, "_ab")
                    .withColumn(out, F.greatest("_pm", "_im") - F.lit(d_ms))
                    .drop("_ab", "_tm", "_im", "_pm"))


def late_rows(df: DataFrame, ts: str = "ts", arrival: str = "seq", delay="0 seconds") -> DataFrame:
    """Rows a stateful stream operator would drop (event time below the watermark)."""
    return watermark_at_arrival(df, ts, arrival, delay).filter(millis(ts) < F.col("wm_ms"))


def admit_from(df: DataFrame, ts: str = "ts", arrival: str = "seq", delay="0 seconds",
               lateness="0 seconds", out: str = "admit_ms") -> DataFrame:
    """Add ``out`` = the smallest window end (epoch ms) a row may still count in:
    ``watermark - lateness + 1 ms`` (null = every window)."""
    l_ms = interval_millis(lateness)
    return (watermark_at_arrival(df, ts, arrival, delay, out="_wm")
            .withColumn(out, F.col("_wm") - F.lit(l_ms) + F.lit(1)).drop("_wm"))
