"""Top-N per window (W1, T1, T2) and latest-version-per-key (upsert).

``row_number() <= n`` directly over the window lets Catalyst insert a
``WindowGroupLimit``: each map task keeps at most ``n`` rows per window before
the shuffle, so the exchange carries ``n x windows x tasks`` rows no matter how
many keys a window has.  Ties are broken on the key, ascending (the reference
keeps arrival order or map order, which is not deterministic).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import interval_millis
from eventide.operators.aggs import finish_exprs
from eventide.operators.windows import reversible, sliding_agg, span_ends, window_spans


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def top_n_per_window(df: DataFrame, n: int, metric: str, key: str | Sequence[str],
                     window_end: str | Sequence[str] = "window_end", descending: bool = True,
                     rank: str = "rank") -> DataFrame:
    """Keep the ``n`` best rows per window by ``metric`` and add ``rank`` (1..n, BIGINT)."""
    order: list[Column] = [F.col(metric).desc() if descending else F.col(metric).asc()]
    order += [F.col(k).asc() for k in _cols(key)]
    w = Window.partitionBy(*_cols(window_end)).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(w))
              .filter(F.col(rank) <= n)
              .withColumn(rank, F.col(rank).cast("long")))


SALTS = 4


RANKED_SPANS = 16  # windows a pane lies in, from which on rankings are made by spans


def _rank_spans(spans: DataFrame, part: list[str], n: int, metric: str, key: str, rank: str) -> DataFrame:
    """The ``n`` best of the spans open at each window end, as spans again.

    ``spans`` (part, key, metric, _from, _to) are hash-partitioned by ``part``, which includes
    the time bucket.  The ranking changes only where a span starts or ends, its turns: at most
    the bucket's window ends a ``part``, which bounds the buffered side of the join.  No exchange."""
    names = [f"_p{i}" for i in range(len(part))]
    turns = (spans.select(*[F.col(c).alias(p) for c, p in zip(part, names)],
                          F.explode(F.array("_from", "_to")).alias("_at")).distinct()
             .withColumn("_next", F.lead("_at").over(Window.partitionBy(*names).orderBy("_at")))
             .filter("_next IS NOT NULL"))
    on = (F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_to"))
    for c, p in zip(part, names):
        on = on & (F.col(c) == F.col(p))
    open_ = spans.join(turns.hint("merge"), on).drop("_from", "_to", *names)
    return (top_n_per_window(open_, n, metric, key, window_end=[*part, "_at"], rank=rank)
            .withColumnsRenamed({"_at": "_from", "_next": "_to"}))


def sliding_top_n(df: DataFrame, size, slide, aggs, key: str, n: int, metric: str, ts: str = "ts",
                  rank: str = "rank", admit: str | None = None, salts: int | None = None) -> DataFrame:
    """Top ``n`` keys per sliding window by an aggregate (Q1, Q12).

    Rows are pre-aggregated per (key, pane); only pane aggregates are shuffled,
    spread by (time bucket, salt = hash(key) mod ``salts``).  Each partition makes
    windows of its panes and keeps its own top ``n`` per window; a second, small
    exchange by bucket then ranks at most ``n * salts`` rows per window.  The salt
    splits a time bucket that holds a large share of the rows over ``salts`` tasks.
    With ``salts=1`` all keys of a window meet in one partition and the ranking
    needs no second exchange; it is the default of rankings by spans, where the second
    ranking costs more than the first (else ``SALTS``).  Give more where the panes of one
    time bucket are too many for a task.

    Reversible aggregates whose panes lie in ``RANKED_SPANS`` windows or more are ranked by
    spans (``window_spans``): once per window end at which anything enters or leaves, and
    only the ranked rows are copied to the window ends in between.  With fewer windows a
    pane, nearly each window differs from the one before, and every window is ranked.
    """
    size_ms, slide_ms = interval_millis(size), interval_millis(slide)
    by_spans = size_ms % slide_ms == 0 and size_ms // slide_ms >= RANKED_SPANS and reversible(aggs)
    salts = salts or (1 if by_spans else SALTS)
    keys = [key]
    if salts > 1:
        df, keys = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts))), [key, "_salt"]
    if by_spans:
        spans = window_spans(df, size_ms, slide_ms, aggs, keys, ts, spread_keys=keys[1:], admit=admit)
        spans = spans.select(*keys, "_bkt", "_from", "_to", *finish_exprs(aggs))
        if salts > 1:
            n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            spans = (_rank_spans(spans, ["_bkt", "_salt"], n, metric, key, "_lr").drop("_lr", "_salt")
                     .repartition(n_parts, "_bkt"))
        ranked = _rank_spans(spans, ["_bkt"], n, metric, key, rank)
        return ranked.withColumn("window_end", span_ends(slide_ms)).drop("_from", "_to")
    counts = sliding_agg(df, size, slide, aggs, keys=keys, ts=ts, spread_keys=keys[1:], keep_bucket=True, admit=admit)
    if salts <= 1:
        return top_n_per_window(counts, n, metric, key, window_end=["_bkt", "window_end"], rank=rank)
    local = top_n_per_window(counts, n, metric, key, window_end=["_bkt", "_salt", "window_end"], rank="_lr")
    return top_n_per_window(local.drop("_lr", "_salt"), n, metric, key, window_end=["_bkt", "window_end"],
                            rank=rank)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """Upsert semantics: keep the row with the greatest ``version`` per key (T2's map state,
    where a later count for the same (window, url) replaces the earlier one)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*[F.col(v).desc() for v in _cols(version)])
    return df.withColumn("_v", F.row_number().over(w)).filter(F.col("_v") == 1).drop("_v")
