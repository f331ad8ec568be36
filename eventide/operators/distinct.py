"""Distinct counts per window.

* ``distinct_per_window``  exact; sliding windows dedupe (keys, pane, value) first.
* ``approx_distinct_per_window``  mergeable HLL sketches (pane aggregation applies).
* ``bitmap_distinct_per_window``  the reference's bitmap: one hash offset per value,
  one bit per offset; the count is the number of set bits.  Bits are grouped in
  Spark's 32768-bit bitmap buckets, so a window costs memory only for the buckets
  it touches (not 64 MiB), and bitmaps merge with ``bitmap_or_agg``.
* ``running_distinct``  one output row per event with the number of distinct
  values seen so far in its window (the reference's fire-per-element trigger).
  First sightings come from an aggregate (hot values are pre-aggregated), the
  running total is a two-level prefix sum so one busy window is split into
  sub-buckets that are summed in parallel.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.hashing import poly_hash
from eventide.functions.time import floor_to, interval_millis, micros, millis
from eventide.operators.aggs import ApproxDistinct
from eventide.operators.windows import BUCKET_WINDOWS, _keys, row_windows, sliding_agg


def _window_end_col(ts: str, size_ms: int) -> F.Column:
    return floor_to(millis(ts), size_ms) + F.lit(size_ms)


DISTINCT_SALTS = 8


def distinct_per_window(df: DataFrame, col: str, size, slide=None, keys=(), ts: str = "ts",
                        out: str = "uv", salts: int = DISTINCT_SALTS) -> DataFrame:
    """Exact number of distinct ``col`` values per (keys, window).

    Tumbling: Spark's two-phase distinct aggregate.  Sliding: values are first
    deduplicated per (keys, pane) with partial aggregation; the (pane, value) rows
    are spread by (keys, time bucket, salt = hash(value) mod ``salts``), expanded to
    their windows inside the partition and counted there; a salt holds a disjoint
    set of values, so the window's count is the sum over salts (a small final
    aggregate).  No exchange carries one row per (window, value).
    """
    keys = _keys(keys)
    size_ms = interval_millis(size)
    slide_ms = interval_millis(slide) if slide else size_ms
    if slide_ms == size_ms:
        grouped = df.groupBy(*keys, _window_end_col(ts, size_ms).alias("window_end"))
        return grouped.agg(F.count_distinct(col).alias(out))
    if size_ms % slide_ms:
        grouped = (df.withColumn("window_end", F.explode(row_windows(millis(ts), size_ms, slide_ms)))
                     .groupBy(*keys, "window_end"))
        return grouped.agg(F.count_distinct(col).alias(out))
    b = BUCKET_WINDOWS * size_ms
    panes = (df.groupBy(*keys, floor_to(millis(ts), slide_ms).alias("_pane"), F.col(col).alias("_v"))
               .agg(F.count(F.lit(1)).alias("_n")))
    pane = F.col("_pane")
    first = floor_to(pane + F.lit(slide_ms - 1), b)
    last = floor_to(pane + F.lit(size_ms - 1), b)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (panes.withColumn("_bkt", F.explode(F.array_distinct(F.array(first, last))))
                   .withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(max(salts, 1))))
                   .repartition(n_parts, *[F.col(k) for k in keys], "_bkt", "_salt"))
    lo = F.greatest(pane + F.lit(slide_ms), F.col("_bkt") + F.lit(slide_ms))
    hi = F.least(pane + F.lit(size_ms), F.col("_bkt") + F.lit(b))
    per_salt = (spread.select(*keys, "_bkt", "_salt", "_v",
                              F.explode(F.sequence(lo, hi, F.lit(slide_ms))).alias("window_end"))
                      .groupBy(*keys, "_bkt", "_salt", "window_end")
                      .agg(F.count_distinct("_v").alias("_d")))
    return per_salt.groupBy(*keys, "window_end").agg(F.sum("_d").cast("long").alias(out))


def approx_distinct_per_window(df: DataFrame, col: str, size, slide=None, keys=(), ts: str = "ts",
                               out: str = "uv", lg_k: int = 12) -> DataFrame:
    """Approximate distinct count per (keys, window) with HLL sketches."""
    return sliding_agg(df, size, slide or size, [ApproxDistinct(out, col, lg_k)], keys, ts)


def bitmap_offset(col: str, df: DataFrame | None = None) -> F.Column:
    """The reference's bitmap offset of a value (hash of its decimal text); integral
    columns use the code-generated digit form."""
    integral = df is not None and isinstance(df.schema[col].dataType, (T.LongType, T.IntegerType,
                                                                       T.ShortType, T.ByteType))
    return poly_hash(col, integral=integral)


def bitmap_distinct_per_window(df: DataFrame, col: str, size, keys=(), ts: str = "ts",
                               out: str = "uv", keep_bitmaps: bool = False) -> DataFrame:
    """Number of distinct bitmap offsets per (keys, tumbling window).

    With ``keep_bitmaps`` the per-bucket bitmaps are returned instead (keys,
    window_end, bucket, bitmap) so they can be stored and OR-merged later.
    """
    keys = _keys(keys)
    size_ms = interval_millis(size)
    pos = bitmap_offset(col, df) + F.lit(1)  # bitmap functions want positive positions
    # distinct offsets by hash aggregation; a binary bitmap buffer could only be sorted
    seen = df.select(*keys, _window_end_col(ts, size_ms).alias("window_end"), pos.alias("_pos")).distinct()
    if not keep_bitmaps:
        return seen.groupBy(*keys, "window_end").agg(F.count("_pos").alias(out))
    return (seen.groupBy(*keys, "window_end", F.bitmap_bucket_number("_pos").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_pos")).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame, keys=(), out: str = "uv") -> DataFrame:
    """Counts from stored per-bucket bitmaps (``keep_bitmaps=True``), possibly written by
    several runs or partitions: OR-merge per (keys, window_end, bucket), then count bits.
    This is the reference's external bitmap store re-aimed as a mergeable table."""
    keys = _keys(keys)
    return (bitmaps.groupBy(*keys, "window_end", "bucket")
                   .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
                   .groupBy(*keys, "window_end")
                   .agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(out)))


# (ts, seq) order as one DECIMAL(38,0): (ts_us + 1e17) * 1e20 + (seq + 2^63).  Years
# 1-9999 and every BIGINT seq fit; min() over it is a hash aggregate with partial
# aggregation, where min() over a struct would sort all rows.
_TS_SHIFT, _SEQ_SHIFT, _SCALE = 10**17, 2**63, 10**20
_D38 = "decimal(38,0)"


def _dec(v: int) -> F.Column:
    return F.lit(Decimal(v)).cast(_D38)


def _order_key(ts_us: F.Column, seq: F.Column) -> F.Column:
    return ((ts_us.cast(_D38) + _dec(_TS_SHIFT)) * _dec(_SCALE) + (seq.cast(_D38) + _dec(_SEQ_SHIFT))).cast(_D38)


def _order_key_seq(key: F.Column) -> F.Column:
    return (F.pmod(key, _dec(_SCALE)) - _dec(_SEQ_SHIFT)).cast("long")


def running_distinct(df: DataFrame, col: str, size, keys=(), ts: str = "ts", seq: str = "seq",
                     hashed: bool = True, sub_bucket=None, out: str = "uv") -> DataFrame:
    """Per event: (seq, keys, window_end, distinct values so far in the window).

    ``hashed=True`` counts distinct bitmap offsets like the reference; ``False``
    counts exact values.  Order inside a window is (ts, seq).

    Plan: first sightings = ``min`` of the packed (ts, seq) key per (window, value), a hash
    aggregate with partial aggregation, so a hot value costs nothing; they are flagged by a join
    on ``seq``; ``running_flags`` counts them (sub-buckets of ``sub_bucket``, default size/60).
    """
    keys = _keys(keys)
    size_ms = interval_millis(size)
    sub_ms = interval_millis(sub_bucket) if sub_bucket else max(size_ms // 60, 1)
    value = bitmap_offset(col, df) if hashed else F.col(col)
    base = df.select(*keys, F.col(seq).alias("_seq"), F.col(ts).alias("_ts"),
                     _window_end_col(ts, size_ms).alias("window_end"),
                     floor_to(millis(ts), sub_ms).alias("_sub"), value.alias("_v"))
    firsts = (base.groupBy(*keys, "window_end", "_v")
                  .agg(F.min(_order_key(micros("_ts"), F.col("_seq"))).alias("_f"))
                  .select(*keys, "window_end", _order_key_seq(F.col("_f")).alias("_seq"), F.lit(1).alias("_new")))
    flagged = (base.join(firsts, [*keys, "window_end", "_seq"], "left")
                   .withColumn("_new", F.coalesce("_new", F.lit(0))))
    counted = running_flags(flagged, [*keys, "window_end"], "_sub", "_new", ["_ts", "_seq"], out)
    return counted.select(F.col("_seq").alias(seq), *keys, "window_end", out)


def running_flags(rows: DataFrame, groups: list[str], sub: str, flag: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: the sum of ``flag`` over the group's rows up to this one, in ``order``.

    ``sub`` cuts a group into spans that follow each other in ``order``.  Two levels: totals per
    span, an exclusive prefix over the spans of a group, and a running sum inside each span plus
    that offset, so a group is as many tasks as it has spans.
    """
    totals = rows.groupBy(*groups, sub).agg(F.sum(flag).alias("_t"))
    spans = Window.partitionBy(*groups).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, sub, F.coalesce(F.sum("_t").over(spans), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*groups, sub).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(offsets, [*groups, sub])
            .withColumn(out, (F.col("_off") + F.sum(flag).over(inside)).cast("long")).drop("_off"))
