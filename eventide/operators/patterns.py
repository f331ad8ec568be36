"""Sequence patterns over keyed, time-ordered events.

* ``strict_pairs``  ``begin(p).next(q).within(W)``: a row satisfying ``p`` whose very
  next row (same keys, order (ts, seq)) satisfies ``q`` and is less than ``W`` later.
  Overlapping matches are all reported.
* ``followed_by``  ``begin(p).followedBy(q).within(W)``: each ``p`` row takes the first
  later ``q`` row; matched if less than ``W`` later, otherwise it times out.  At the
  end of the input every open ``p`` row times out.

Scale (H2): a lookahead bounded by ``W`` does not need a whole key in one task.
Rows get a time bucket ``floor(t/B)`` (``B >= W``); rows that may be looked at from
the previous bucket (``t - W`` falls in it) are copied there, and results are kept
only for rows in their home bucket.  Partitions are then (keys, bucket): a hot key
is spread over its time buckets, and an unkeyed pattern runs in parallel instead of
in one task.  The first-later search (H3) runs over the reversed order with a
frame ending one row before the current one, which Spark evaluates incrementally.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import interval_micros, micros

BUCKETS_PER_WITHIN = 4
CHAIN_BUCKET_US = 3_600_000_000  # chain buckets without a time limit: one hour


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _bucketed(df: DataFrame, ts: str, within_us: int | None, bucket_us: int | None,
              copy_if: Column | None = None) -> tuple[DataFrame, list[str]]:
    """Add ``_b`` (bucket) and ``_home`` (row is in its own bucket); copy rows that a
    row of the previous bucket may reach within ``within``."""
    if within_us is None:
        return df.withColumn("_home", F.lit(True)), []
    b = bucket_us or max(within_us, 1) * BUCKETS_PER_WITHIN
    if b < within_us:
        raise ValueError("bucket width must be at least the pattern's time limit")
    us = micros(ts)
    # bucket ids as bucket start times (exact integer floor; no division needed)
    home = us - F.pmod(us, F.lit(b))
    back = (us - F.lit(within_us)) - F.pmod(us - F.lit(within_us), F.lit(b))
    copy = back != home
    if copy_if is not None:
        copy = copy & copy_if
    buckets = F.when(copy, F.array(F.struct(home.alias("b"), F.lit(True).alias("h")),
                                   F.struct(back.alias("b"), F.lit(False).alias("h")))) \
               .otherwise(F.array(F.struct(home.alias("b"), F.lit(True).alias("h"))))
    out = (df.withColumn("_bk", F.explode(buckets))
             .withColumn("_b", F.col("_bk.b")).withColumn("_home", F.col("_bk.h")).drop("_bk"))
    return out, ["_b"]


def _ordered_rows(df: DataFrame, ts: str, seq: str, keys) -> DataFrame:
    """Rows without time, order or key cannot take part in a sequence: they are ignored
    by every pattern (the reference cannot key or time such rows at all)."""
    df = df.filter(F.col(ts).isNotNull() & F.col(seq).isNotNull())
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def _chain_bucket(df: DataFrame, ts: str, seq: str, keys, bucket_us: int) -> DataFrame:
    """Time buckets for the chain strategy.  The bucket column is non-nullable, so Spark
    reuses one shuffle of the rows for the per-bucket pass and the per-bucket summary."""
    us = micros(ts)
    return df.withColumn("_b", F.coalesce(us - F.pmod(us, F.lit(bucket_us)), F.lit(0)))


def strict_pairs(df: DataFrame, begin: Column, nxt: Column, within, keys=(), ts: str = "ts",
                 seq: str = "seq", carry=(), bucket=None, method: str = "auto") -> DataFrame:
    """Pairs (row, next row) with ``begin`` on the first, ``nxt`` on the second and
    ``second.ts - first.ts < within``.

    Output: keys, first_ts, first_seq, second_ts, second_seq and ``first_<c>`` /
    ``second_<c>`` for each column in ``carry``.  ``within=None`` means no limit.

    ``method``: ``"copy"`` (H2: buckets of width ``bucket`` >= ``within``, rows near a
    bucket start copied back), ``"chain"`` (buckets of any width; each bucket's last
    row takes the first row of the key's next non-empty bucket from a per-bucket
    summary), ``"auto"`` = copy with a time limit (keyed or not: no row or summary then
    meets the others in one task), else chain.
    """
    keys = _keys(keys)
    carry = list(carry)
    w_us = interval_micros(within) if within is not None else None
    if method == "auto":
        method = "copy" if w_us is not None else "chain"
    base = _ordered_rows(df, ts, seq, keys).select(*keys, ts, seq, *carry, begin.alias("_p"), nxt.alias("_q"))
    nxt_cols = [ts, seq, "_q", *carry]
    if method == "copy":
        base, bcol = _bucketed(base, ts, w_us, interval_micros(bucket) if bucket else None)
        w = Window.partitionBy(*keys, *bcol).orderBy(F.col(ts), F.col(seq))
        staged = base.select("*", *[F.lead(c).over(w).alias(f"_n_{c}") for c in nxt_cols])
    elif method == "chain":
        b_us = interval_micros(bucket) if bucket else (w_us or CHAIN_BUCKET_US)
        base = _chain_bucket(base, ts, seq, keys, b_us).withColumn("_home", F.lit(True))
        w = Window.partitionBy(*keys, "_b").orderBy(F.col(ts), F.col(seq))
        local = base.select("*", *[F.lead(c).over(w).alias(f"_l_{c}") for c in nxt_cols])
        first = (local.groupBy(*keys, "_b")
                      .agg(F.min(F.struct(*[F.col(c) for c in nxt_cols])).alias("_first")))
        wk = Window.partitionBy(*keys).orderBy("_b")
        nb = first.select(*keys, "_b", F.lead("_first").over(wk).alias("_nb"))
        joined = local.join(nb, [*keys, "_b"])
        last = F.col(f"_l_{ts}").isNull()
        staged = joined.select("*", *[F.when(last, F.col(f"_nb.{c}")).otherwise(F.col(f"_l_{c}"))
                                      .alias(f"_n_{c}") for c in nxt_cols])
    else:
        raise ValueError(f"unknown method {method!r}")
    cond = F.col("_home") & F.col("_p") & F.coalesce(F.col("_n__q"), F.lit(False))
    if w_us is not None:
        cond = cond & ((micros(F.col(f"_n_{ts}")) - micros(F.col(ts))) < F.lit(w_us))
    return staged.filter(cond).select(
        *keys,
        F.col(ts).alias("first_ts"), F.col(seq).alias("first_seq"),
        F.col(f"_n_{ts}").alias("second_ts"), F.col(f"_n_{seq}").alias("second_seq"),
        *[F.col(c).alias(f"first_{c}") for c in carry],
        *[F.col(f"_n_{c}").alias(f"second_{c}") for c in carry])


class PatternResult(NamedTuple):
    matched: DataFrame    # keys, begin_ts, begin_seq, follow_ts, follow_seq (+ carried columns)
    timed_out: DataFrame  # keys, begin_ts, begin_seq (+ carried columns)


def followed_by(df: DataFrame, begin: Column, follow: Column, within, keys=(), ts: str = "ts",
                seq: str = "seq", carry=(), bucket=None, method: str = "auto") -> PatternResult:
    """Relaxed contiguity: each ``begin`` row takes the first later ``follow`` row.

    ``method`` as in ``strict_pairs``: ``"copy"`` (H2, buckets >= ``within``) or
    ``"chain"`` (any bucket width: a begin row with no later follow row in its bucket
    takes the first follow row of the key's next bucket that has one).
    """
    outcome = followed_by_outcome(df, begin, follow, within, keys, ts, seq, carry, bucket, method)
    late = [c for c in outcome.columns if c != "branch" and not c.startswith("follow_")]
    return PatternResult(outcome.filter("branch = 'matched'").drop("branch"),
                         outcome.filter("branch = 'timed_out'").select(*late))


def followed_by_outcome(df: DataFrame, begin: Column, follow: Column, within, keys=(), ts: str = "ts",
                        seq: str = "seq", carry=(), bucket=None, method: str = "auto") -> DataFrame:
    """``followed_by`` as one frame (S10): a row per begin row, its ``branch`` ('matched' or
    'timed_out') and its follow row (null when timed out)."""
    keys = _keys(keys)
    carry = list(carry)
    w_us = interval_micros(within) if within is not None else None
    if method == "auto":
        method = "copy" if keys and w_us is not None else "chain"
    # relaxed contiguity ignores rows that are neither begin nor follow: drop them first
    # (simple predicates then reach the scan)
    base = (_ordered_rows(df, ts, seq, keys).filter(begin | follow)
              .select(*keys, ts, seq, *carry, begin.alias("_p"), follow.alias("_q")))
    payload = F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"), *[F.col(c) for c in carry])
    if method == "copy":
        # only follow rows are looked at from the previous bucket
        base, bcol = _bucketed(base, ts, w_us, interval_micros(bucket) if bucket else None,
                               copy_if=F.col("_q"))
    elif method == "chain":
        base = _chain_bucket(base, ts, seq, keys,
                             interval_micros(bucket) if bucket else (w_us or CHAIN_BUCKET_US)) \
            .withColumn("_home", F.lit(True))
        bcol = ["_b"]
    else:
        raise ValueError(f"unknown method {method!r}")
    # reversed order + frame (unbounded preceding, -1): "last" = nearest later follow row
    w = (Window.partitionBy(*keys, *bcol).orderBy(F.col(ts).desc(), F.col(seq).desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    nxt = F.last(F.when(F.col("_q"), payload), ignorenulls=True).over(w)
    staged = base.select(*keys, *bcol, ts, seq, *carry, "_p", "_q", "_home", nxt.alias("_f"))
    if method == "chain":
        # first follow row of each bucket; a bucket's begin rows without a later follow
        # inside it take the first follow row of the next bucket that has one (H3 again,
        # over one summary row per bucket)
        firsts = (staged.groupBy(*keys, "_b")
                        .agg(F.min(F.when(F.col("_q"), payload)).alias("_fq")))
        wk = (Window.partitionBy(*keys).orderBy(F.col("_b").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
        nb = firsts.select(*keys, "_b", F.last("_fq", ignorenulls=True).over(wk).alias("_nb"))
        staged = (staged.filter(F.col("_p")).join(nb, [*keys, "_b"])
                        .withColumn("_f", F.coalesce(F.col("_f"), F.col("_nb"))))
    starts = staged.filter(F.col("_home") & F.col("_p"))
    ok = F.col("_f").isNotNull()
    if w_us is not None:
        ok = ok & ((micros(F.col("_f.t")) - micros(F.col(ts))) < F.lit(w_us))
    f = F.when(ok, F.col("_f"))
    return starts.select(
        *keys, F.col(ts).alias("begin_ts"), F.col(seq).alias("begin_seq"), *[F.col(c).alias(f"begin_{c}") for c in carry],
        f["t"].alias("follow_ts"), f["s"].alias("follow_seq"), *[f[c].alias(f"follow_{c}") for c in carry],
        F.when(ok, F.lit("matched")).otherwise(F.lit("timed_out")).alias("branch"))
