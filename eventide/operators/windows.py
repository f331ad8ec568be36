"""Event-time window aggregates.

Windows are epoch-aligned and half-open ``[start, end)``; only non-empty
windows produce rows, like Spark's ``window()``.  Bounds are exact integer
arithmetic on epoch milliseconds; outputs carry ``window_start`` /
``window_end`` as BIGINT epoch ms.

Sliding windows use *pane aggregation* by default: rows are aggregated once per
(keys, slide-wide pane) with map-side partial aggregation, and only the
aggregated panes are expanded to the ``size/slide`` windows that contain them
and merged again.  A plain ``window()``-style expansion copies every input row
``size/slide`` times before any aggregation (360x for 1 h / 10 s).

Counts need no copies at all (``window_spans``): a pane is
added at the first window end that holds it and subtracted after the last, and a
running sum per key gives the spans of window ends over which nothing changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import floor_to, interval_millis, millis
from eventide.operators.aggs import Agg, Count, finish_exprs, merge_exprs, partial_exprs


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def tumbling_end(ts: str, size) -> Column:
    """End (epoch ms) of the tumbling window a row falls in."""
    size_ms = interval_millis(size)
    return floor_to(millis(ts), size_ms) + F.lit(size_ms)


def tumbling_agg(df: DataFrame, size, aggs: Sequence[Agg], keys=(), ts: str = "ts",
                 offset=0, with_start: bool = False, admit: str | None = None) -> DataFrame:
    """Aggregate per (keys, tumbling window).  Output: keys, [window_start], window_end, aggs.

    ``admit`` names a column with the smallest window end (epoch ms) each row may count
    in (see ``operators.late.admit_from``); null admits the row everywhere."""
    keys = _keys(keys)
    size_ms, off_ms = interval_millis(size), interval_millis(offset)
    we = floor_to(millis(ts), size_ms, off_ms) + F.lit(size_ms)
    if admit is not None:
        df = df.filter(F.col(admit).isNull() | (we >= F.col(admit)))
    out = df.groupBy(*keys, we.alias("window_end")).agg(*partial_exprs(aggs))
    cols = [*keys]
    if with_start:
        cols.append((F.col("window_end") - F.lit(size_ms)).alias("window_start"))
    return out.select(*cols, "window_end", *finish_exprs(aggs))


def pane_windows(pane_start_ms: Column, size_ms: int, slide_ms: int) -> Column:
    """Ends of the ``size/slide`` sliding windows that contain the pane starting at
    ``pane_start_ms`` (``sequence`` is code-generated; no lambda functions)."""
    return F.sequence(pane_start_ms + F.lit(slide_ms), pane_start_ms + F.lit(size_ms), F.lit(slide_ms))


def row_windows(t_ms: Column, size_ms: int, slide_ms: int, offset_ms: int = 0) -> Column:
    """Ends of all sliding windows ``[s, s + size)`` holding ``t_ms``, where starts ``s``
    lie on the slide grid (general form, also when size is not a multiple of slide)."""
    first_start = floor_to(t_ms - F.lit(size_ms), slide_ms, offset_ms) + F.lit(slide_ms)
    last_start = floor_to(t_ms, slide_ms, offset_ms)
    return F.sequence(first_start + F.lit(size_ms), last_start + F.lit(size_ms), F.lit(slide_ms))


BUCKET_WINDOWS = 4  # time bucket width for the local window expansion, in window sizes


def pane_aggregates(df: DataFrame, slide_ms: int, aggs: Sequence[Agg], keys, ts: str,
                    offset_ms: int = 0, size_ms: int | None = None, admit: str | None = None) -> DataFrame:
    """Partial aggregates per (keys, pane); pane = ``_pane`` start (epoch ms).

    With ``admit`` the rows of a pane are also split by ``_first``, the first window
    end they count in (rows on time share ``pane + slide``); rows admitted nowhere
    are dropped."""
    pane = floor_to(millis(ts), slide_ms, offset_ms)
    first = pane + F.lit(slide_ms)
    if admit is not None:
        # smallest end on the slide grid that is >= admit
        a = F.col(admit)
        aligned = floor_to(a - F.lit(1), slide_ms, offset_ms) + F.lit(slide_ms)
        first = F.when(a.isNull(), first).otherwise(F.greatest(first, aligned))
        df = df.filter(first <= pane + F.lit(size_ms))
    return df.groupBy(*keys, pane.alias("_pane"), first.alias("_first")).agg(*partial_exprs(aggs))


def _spread_panes(panes: DataFrame, size_ms: int, slide_ms: int, keys, spread_keys, bucket_ms: int | None,
                  offset_ms: int) -> tuple[DataFrame, Column, Column]:
    """Panes hash-partitioned by (spread_keys, time bucket ``_bkt``), at most two copies each,
    and the first and last window end of a pane in its bucket."""
    spread_keys = list(keys if spread_keys is None else spread_keys)
    b = bucket_ms or BUCKET_WINDOWS * size_ms
    if b < size_ms or b % slide_ms:
        raise ValueError("bucket must be a whole number of slides, at least one window long")
    pane = F.col("_pane")
    first = floor_to(F.col("_first") - F.lit(1), b, offset_ms)
    last = floor_to(pane + F.lit(size_ms - 1), b, offset_ms)
    # a fixed partition count: the rows multiply after the exchange, so AQE must not
    # coalesce these partitions by their (small) shuffle size
    n_parts = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (panes.withColumn("_bkt", F.explode(F.array_distinct(F.array(first, last))))
                   .repartition(n_parts, *[F.col(k) for k in spread_keys], F.col("_bkt")))
    # window ends e of this pane with bucket < e <= bucket + b, on the slide grid
    lo = F.greatest(F.col("_first"), F.col("_bkt") + F.lit(slide_ms))
    hi = F.least(pane + F.lit(size_ms), F.col("_bkt") + F.lit(b))
    return spread, lo, hi


def expand_panes_local(panes: DataFrame, size_ms: int, slide_ms: int, aggs: Sequence[Agg], keys,
                       spread_keys=None, bucket_ms: int | None = None, offset_ms: int = 0) -> DataFrame:
    """Merge pane partials into sliding windows with one small shuffle.

    Window ends are grouped in time buckets of ``bucket_ms`` (>= size).  A pane
    reaches at most two buckets, so pane rows are copied at most twice, then
    hash-partitioned by (spread_keys, bucket).  The expansion to ``size/slide``
    window ends and the merge run inside each partition: the exchange carries
    pane aggregates only, never one row per (key, window).  Output keeps the
    bucket as ``_bkt`` so later operators (top-N) can stay in the same partitions.
    """
    spread, lo, hi = _spread_panes(panes, size_ms, slide_ms, keys, spread_keys, bucket_ms, offset_ms)
    partial_cols = [n for a in aggs for n, _ in a.partials()]
    return (spread.select(*keys, "_bkt", F.explode(F.sequence(lo, hi, F.lit(slide_ms))).alias("window_end"),
                          *partial_cols)
                  .groupBy(*keys, "_bkt", "window_end")
                  .agg(*merge_exprs(aggs)))


def reversible(aggs: Sequence[Agg]) -> bool:
    return all(a.reversible for a in aggs)


def window_spans(df: DataFrame, size_ms: int, slide_ms: int, aggs: Sequence[Agg], keys, ts: str = "ts",
                 spread_keys=None, offset_ms: int = 0, admit: str | None = None) -> DataFrame:
    """Sliding windows as spans (keys, _bkt, _from, _to, partials): every window end of
    ``[_from, _to)`` on the slide grid holds the same panes of the key.

    Needs reversible aggregates and ``size % slide == 0``.  After the pane exchange (see
    ``expand_panes_local``) each pane is two rows, whatever ``size / slide`` is: its partials
    where it enters, and their negatives one slide after its last window end.  A key's running
    sum over one bucket is the window's partials, up to the next step.  At the end of a bucket
    all its panes leave, so no sum reaches beyond it."""
    live = Count("_live")
    panes = pane_aggregates(df, slide_ms, [*aggs, live], keys, ts, offset_ms, size_ms, admit)
    spread, lo, hi = _spread_panes(panes, size_ms, slide_ms, keys, spread_keys, None, offset_ms)
    cols = [n for a in (*aggs, live) for n, _ in a.partials()]
    enter = F.struct(lo.alias("_from"), *[F.col(c).alias(c) for c in cols])
    leave = F.struct((hi + F.lit(slide_ms)).alias("_from"), *[(-F.col(c)).alias(c) for c in cols])
    steps = (spread.select(*keys, "_bkt", F.inline(F.array(enter, leave)))
             .groupBy(*keys, "_bkt", "_from").agg(*[F.sum(c).alias(c) for c in cols]))
    order = Window.partitionBy(*keys, "_bkt").orderBy("_from")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (steps.select(*keys, "_bkt", "_from", F.lead("_from").over(order).alias("_to"),
                         *[F.sum(c).over(upto).alias(c) for c in cols])
            .filter(F.col(live._p()) > 0).drop(live._p()))


def span_ends(slide_ms: int, start: str = "_from", stop: str = "_to") -> Column:
    """Window ends of a span, exploded."""
    return F.explode(F.sequence(F.col(start), F.col(stop) - F.lit(slide_ms), F.lit(slide_ms)))


def sliding_agg(df: DataFrame, size, slide, aggs: Sequence[Agg], keys=(), ts: str = "ts",
                offset=0, method: str = "panes", with_start: bool = False,
                spread_keys=None, keep_bucket: bool = False, admit: str | None = None) -> DataFrame:
    """Aggregate per (keys, sliding window of ``size`` every ``slide``).

    ``method="panes"`` (default, H1) needs ``size % slide == 0``: rows are aggregated
    per (keys, pane) with map-side partial aggregation, and only pane aggregates are
    shuffled; they become windows by running sums where all aggregates are reversible
    (``window_spans``), else by expansion (``expand_panes_local``, also ``method="copies"``).  ``method="expand"`` (or a
    size that is not a multiple of the slide) copies every row to its windows first.
    ``spread_keys`` picks the partitioning of the expansion (default: the keys;
    ``[]`` = by time bucket only, so all keys of a window meet in one partition).
    ``admit`` names a column with the smallest window end each row may count in
    (allowed lateness, see ``operators.late.admit_from``).
    Output: keys, [window_start], window_end, aggs (+ ``_bkt`` with ``keep_bucket``).
    """
    keys = _keys(keys)
    size_ms, slide_ms, off_ms = interval_millis(size), interval_millis(slide), interval_millis(offset)
    if size_ms == slide_ms and not keep_bucket:
        return tumbling_agg(df, size, aggs, keys, ts, offset, with_start, admit)
    extra = []
    if method == "panes" and size_ms % slide_ms == 0 and reversible(aggs):
        spans = window_spans(df, size_ms, slide_ms, aggs, keys, ts, spread_keys, off_ms, admit)
        out = spans.withColumn("window_end", span_ends(slide_ms))
        extra = ["_bkt"] if keep_bucket else []
    elif method in ("panes", "copies") and size_ms % slide_ms == 0:
        panes = pane_aggregates(df, slide_ms, aggs, keys, ts, off_ms, size_ms, admit)
        out = expand_panes_local(panes, size_ms, slide_ms, aggs, keys, spread_keys, offset_ms=off_ms)
        extra = ["_bkt"] if keep_bucket else []
    elif method in ("panes", "copies", "expand"):
        if keep_bucket:
            raise ValueError("keep_bucket needs pane aggregation")
        exploded = df.withColumn("window_end", F.explode(row_windows(millis(ts), size_ms, slide_ms, off_ms)))
        if admit is not None:
            exploded = exploded.filter(F.col(admit).isNull() | (F.col("window_end") >= F.col(admit)))
        out = (exploded
               .groupBy(*keys, "window_end")
               .agg(*partial_exprs(aggs)))
    else:
        raise ValueError(f"unknown method {method!r}")
    cols = [*keys]
    if with_start:
        cols.append((F.col("window_end") - F.lit(size_ms)).alias("window_start"))
    return out.select(*cols, "window_end", *finish_exprs(aggs), *extra)
