"""Two-input operators: interval join (J1) and one-to-one pairing.

Interval join
    ``left.k = right.k and left.ts + lower <= right.ts <= left.ts + upper`` (both
    bounds inclusive), many-to-many.  Planned as an equi-join on the keys plus a
    time bucket, with the range as a residual predicate.  The bucket splits a hot
    key into slices of width ``B >= upper - lower``: each left row sits in its own
    bucket, each right row is copied to the (at most two) buckets its range can
    reach, so every pair is produced exactly once and a key holding a third of all
    rows becomes many join tasks.  Catalyst/AQE choose sort-merge or a broadcast
    from measured sizes (no hint), and AQE splits any remaining skewed partitions.

One-to-one pairing
    The reference's connect + two pending slots: per key in event order a row
    closes the pending row of the other side, else becomes pending on its own side,
    overwriting a pending row of the same side.  Closed form (one exchange on the
    key, one sort): a row starts a new run when it has the same side as the
    previous row (or, with a timeout, when the gap to the previous row exceeds it);
    inside a run rows pair up (1,2), (3,4), ...; an odd last row of a run is
    pending: *overwritten* when a same-side row follows in time, *unmatched*
    when its timeout passes first or the input ends.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import interval_micros, micros

BUCKETS_PER_SPAN = 4


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def interval_join(left: DataFrame, right: DataFrame, on, lower, upper, left_ts: str = "ts",
                  right_ts: str = "ts", left_prefix: str = "left_", right_prefix: str = "right_",
                  bucket="auto") -> DataFrame:
    """Inner interval join.  ``lower``/``upper`` are signed offsets of the right time
    from the left time (``"-15 seconds"``, ``"15 seconds"``; ints are microseconds).

    Output: the keys, then the other left columns with ``left_prefix`` and the other
    right columns with ``right_prefix``.  ``bucket=None`` disables time buckets.
    """
    keys = _keys(on)
    lo, hi = _signed_us(lower), _signed_us(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    l = left.select(*keys, *[F.col(c).alias(left_prefix + c) for c in left.columns if c not in keys])
    r = right.select(*keys, *[F.col(c).alias(right_prefix + c) for c in right.columns if c not in keys])
    lt, rt = micros(F.col(left_prefix + left_ts)), micros(F.col(right_prefix + right_ts))
    cond = [l[k] == r[k] for k in keys]
    if bucket is not None:
        width = (max(hi - lo, 1) * BUCKETS_PER_SPAN) if bucket == "auto" else interval_micros(bucket)
        if width < hi - lo:
            raise ValueError("bucket width must cover the join interval")
        l = l.withColumn("_b", lt - F.pmod(lt, F.lit(width)))
        first = (rt - F.lit(hi)) - F.pmod(rt - F.lit(hi), F.lit(width))
        last = (rt - F.lit(lo)) - F.pmod(rt - F.lit(lo), F.lit(width))
        r = r.withColumn("_b", F.explode(F.array_distinct(F.array(first, last))))
        cond.append(l["_b"] == r["_b"])
        lt, rt = micros(l[left_prefix + left_ts]), micros(r[right_prefix + right_ts])
    cond.append(rt >= lt + F.lit(lo))
    cond.append(rt <= lt + F.lit(hi))
    out = l.join(r, cond, "inner")
    cols = [l[k] for k in keys] + [l[c] for c in l.columns if c not in keys and c != "_b"] \
        + [r[c] for c in r.columns if c not in keys and c != "_b"]
    return out.select(*cols)


def _signed_us(v) -> int:
    if isinstance(v, str) and v.strip().startswith("-"):
        return -interval_micros(v.strip()[1:])
    return interval_micros(v)


class PairResult(NamedTuple):
    matched: DataFrame      # key, left_*, right_*
    left_only: DataFrame    # key, left_*, reason ('end' or 'timeout')
    right_only: DataFrame   # key, right_*, reason
    overwritten: DataFrame  # key, side ('left'/'right'), payload columns of that side


def pair_one_to_one(left: DataFrame, right: DataFrame, on, ts: str = "ts", seq: str = "seq",
                    timeout=None, left_prefix: str = "left_", right_prefix: str = "right_",
                    bucket="1 hour") -> PairResult:
    """One-to-one pairing of two keyed inputs (order (ts, seq) per key; on equal
    (ts, seq) the left row goes first).  ``timeout=None`` is the reference as shipped
    (pending rows are reported at the end of input); a timeout makes a pending row
    unmatched once the other side has not arrived within it (a row exactly
    ``timeout`` later still pairs).

    ``bucket`` (default one hour; ``None`` = whole keys per task) splits each key's
    history into time buckets that are numbered in parallel; only one summary row
    per (key, bucket) travels to a per-key window, which carries the run position and
    the neighbouring rows across bucket borders.  A key holding a third of all rows
    is then spread over its buckets instead of landing in one task.
    """
    keys = _keys(on)
    b, lcols, rcols = _judged_runs(left, right, keys, ts, seq, timeout, bucket)

    def side_cols(struct: str, names, prefix):
        return [F.col(f"{struct}.{c}").alias(prefix + c) for c in names]

    matched = _matched(b, keys, lcols, rcols, left_prefix, right_prefix)
    reason = F.when(F.col("_nside").isNull(), F.lit("end")).otherwise(F.lit("timeout"))
    unmatched = b.filter(F.col("_pending") & ~F.col("_over"))
    left_only = unmatched.filter(F.col("_side") == 0).select(
        *keys, *side_cols("_l", lcols, left_prefix), reason.alias("reason"))
    right_only = unmatched.filter(F.col("_side") == 1).select(
        *keys, *side_cols("_r", rcols, right_prefix), reason.alias("reason"))
    over = b.filter("_over").select(
        *keys, F.when(F.col("_side") == 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
        F.col("_t").alias(ts), F.col("_s").alias(seq))
    return PairResult(matched, left_only, right_only, over)


def _judged_runs(left, right, keys, ts, seq, timeout, bucket):
    """The rows of both sides with _closes / _pending / _over, and the payload columns of each side."""
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    ltype = left.select(F.struct(*lcols).alias("x")).schema["x"].dataType
    rtype = right.select(F.struct(*rcols).alias("x")).schema["x"].dataType
    u = left.select(*keys, F.col(ts).alias("_t"), F.col(seq).alias("_s"), F.lit(0).alias("_side"),
                    F.struct(*lcols).alias("_l"), F.lit(None).cast(rtype).alias("_r")).unionByName(
        right.select(*keys, F.col(ts).alias("_t"), F.col(seq).alias("_s"), F.lit(1).alias("_side"),
                     F.lit(None).cast(ltype).alias("_l"), F.struct(*rcols).alias("_r")))
    # rows without key or time cannot be ordered; dropping them here also keeps the
    # bucket column non-nullable, so both uses of the bucketed rows share one shuffle
    u = u.filter(F.col("_t").isNotNull() & F.col("_s").isNotNull())
    for k in keys:
        u = u.filter(F.col(k).isNotNull())
    t_us = interval_micros(timeout) if timeout is not None else None
    if bucket is None:
        b = _runs_plain(u, keys, t_us)
    else:
        b = _runs_bucketed(u, keys, t_us, interval_micros(bucket))
    # b has per row: _brk (row starts a run), _pos (position in its run), _pl/_pr (previous
    # row's payloads), _nside/_nt (next row of the key, null at the end)
    nbrk = F.when(F.col("_nside").isNull(), F.lit(None)).otherwise(_starts_run(
        F.col("_nside"), F.col("_side"), micros("_nt") - micros("_t"), t_us))
    closes = (F.col("_pos") % 2) == 0
    pending = ((F.col("_pos") % 2) == 1) & F.coalesce(nbrk, F.lit(True))
    overwritten = pending & F.col("_nside").isNotNull() & (F.col("_nside") == F.col("_side"))
    if t_us is not None:
        # a same-side successor after the timeout means the timer fired first
        overwritten = overwritten & ((micros("_nt") - micros("_t")) <= F.lit(t_us))
    b = b.withColumn("_closes", closes).withColumn("_pending", pending).withColumn("_over", overwritten)
    return b, lcols, rcols


OUTCOME = "branch"


def pair_outcome(left: DataFrame, right: DataFrame, on, ts: str = "ts", seq: str = "seq", timeout=None,
                 left_prefix: str = "left_", right_prefix: str = "right_", bucket="1 hour") -> DataFrame:
    """``pair_one_to_one`` as one frame (S10): each outcome is a row with ``branch`` and the columns
    of its branch, null elsewhere.  Written once, partitioned by branch, it reads each input once.
    """
    keys = _keys(on)
    b, lcols, rcols = _judged_runs(left, right, keys, ts, seq, timeout, bucket)
    is_left, pair, over = F.col("_side") == 0, F.col("_closes"), F.col("_over")
    branch = (F.when(pair, "matched").when(over, "overwritten").when(F.col("_pending") & is_left, "left_only")
              .when(F.col("_pending"), "right_only"))
    lrow = F.when(~over, F.when(is_left, F.col("_l")).when(pair, F.col("_pl")))
    rrow = F.when(~over, F.when(~is_left, F.col("_r")).when(pair, F.col("_pr")))
    end = F.when(F.col("_nside").isNull(), F.lit("end")).otherwise(F.lit("timeout"))
    rows = b.select(*keys, branch.alias(OUTCOME), lrow.alias("_ml"), rrow.alias("_mr"),
                    F.when(~pair & ~over, end).alias("reason"),
                    F.when(over, F.when(is_left, F.lit("left")).otherwise(F.lit("right"))).alias("side"),
                    F.when(over, F.col("_t")).alias(ts), F.when(over, F.col("_s")).alias(seq))
    return rows.filter(F.col(OUTCOME).isNotNull()).select(
        *keys, OUTCOME, *[F.col(f"_ml.{c}").alias(left_prefix + c) for c in lcols],
        *[F.col(f"_mr.{c}").alias(right_prefix + c) for c in rcols], "reason", "side", ts, seq)


def _starts_run(side, prev_side, gap_us, t_us):
    """A row starts a new run when it is on the same side as the previous row, or when
    the previous row is more than the timeout older."""
    c = side == prev_side
    if t_us is not None:
        c = c | (gap_us > F.lit(t_us))
    return c


def _runs_plain(u: DataFrame, keys, t_us) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("_t", "_s", "_side")
    prev_side = F.lag("_side").over(w)
    brk = prev_side.isNull() | _starts_run(F.col("_side"), prev_side,
                                           micros("_t") - micros(F.lag("_t").over(w)), t_us)
    a = u.select("*", brk.alias("_brk"), F.row_number().over(w).alias("_rn"),
                 F.lag("_l").over(w).alias("_pl"), F.lag("_r").over(w).alias("_pr"),
                 F.lead("_side").over(w).alias("_nside"), F.lead("_t").over(w).alias("_nt"))
    wrun = w.rowsBetween(Window.unboundedPreceding, 0)
    return a.withColumn("_pos", F.col("_rn") - F.max(F.when(F.col("_brk"), F.col("_rn"))).over(wrun) + 1)


def _runs_bucketed(u: DataFrame, keys, t_us, width_us: int) -> DataFrame:
    us = micros("_t")
    u = u.withColumn("_b", F.coalesce(us - F.pmod(us, F.lit(width_us)), F.lit(0)))
    wb = Window.partitionBy(*keys, "_b").orderBy("_t", "_s", "_side")
    lside = F.lag("_side").over(wb)
    brk_loc = F.when(lside.isNull(), F.lit(None)).otherwise(
        _starts_run(F.col("_side"), lside, us - micros(F.lag("_t").over(wb)), t_us))
    a = u.select("*", brk_loc.alias("_brk_loc"), F.row_number().over(wb).alias("_rn"),
                 F.lag("_l").over(wb).alias("_pl_loc"), F.lag("_r").over(wb).alias("_pr_loc"),
                 F.lead("_side").over(wb).alias("_nside_loc"), F.lead("_t").over(wb).alias("_nt_loc"))
    a = a.withColumn("_lastbrk", F.max(F.when(F.col("_brk_loc"), F.col("_rn"))).over(
        wb.rowsBetween(Window.unboundedPreceding, 0)))
    row = F.struct("_t", "_s", "_side", "_l", "_r")
    summary = a.groupBy(*keys, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"), F.max(row).alias("_last"),
        F.max(F.when(F.col("_brk_loc"), F.col("_rn"))).alias("_lb"))
    wk = Window.partitionBy(*keys).orderBy("_b")
    prev_last = F.lag("_last").over(wk)
    brk_first = prev_last.isNull() | _starts_run(
        F.col("_first._side"), prev_last["_side"], micros(F.col("_first._t")) - micros(prev_last["_t"]), t_us)
    s1 = summary.select("*", brk_first.alias("_brk_first"), prev_last.alias("_prev_last"),
                        F.lead("_first").over(wk).alias("_next_first"),
                        F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, 0)).alias("_c"))
    # position of the bucket's last row in its run: counted from the latest bucket with a break
    tail = F.when(F.col("_lb").isNotNull(), F.col("_n") - F.col("_lb") + 1) \
            .when(F.col("_brk_first"), F.col("_n"))
    latest = F.last(F.when(tail.isNotNull(), F.struct(tail.alias("tl"), F.col("_c").alias("c"))),
                    ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, 0))
    s2 = s1.withColumn("_latest", latest) \
           .withColumn("_pos_last", F.col("_latest.tl") + F.col("_c") - F.col("_latest.c"))
    s3 = s2.select(*keys, "_b", "_brk_first", "_prev_last", "_next_first",
                   F.lag("_pos_last").over(wk).alias("_carry"))
    j = a.join(s3, [*keys, "_b"])
    first_row = F.col("_rn") == 1
    pos = F.when(F.col("_lastbrk").isNotNull(), F.col("_rn") - F.col("_lastbrk") + 1) \
           .when(F.col("_brk_first"), F.col("_rn")).otherwise(F.col("_carry") + F.col("_rn"))
    return j.select(
        *keys, "_t", "_s", "_side", "_l", "_r",
        F.when(first_row, F.col("_brk_first")).otherwise(F.col("_brk_loc")).alias("_brk"),
        pos.alias("_pos"),
        F.when(first_row, F.col("_prev_last._l")).otherwise(F.col("_pl_loc")).alias("_pl"),
        F.when(first_row, F.col("_prev_last._r")).otherwise(F.col("_pr_loc")).alias("_pr"),
        F.when(F.col("_nside_loc").isNull(), F.col("_next_first._side")).otherwise(F.col("_nside_loc"))
         .alias("_nside"),
        F.when(F.col("_nside_loc").isNull(), F.col("_next_first._t")).otherwise(F.col("_nt_loc")).alias("_nt"))


def _matched(b: DataFrame, keys, lcols, rcols, lp, rp) -> DataFrame:
    """The closing row of a pair carries the opening row in ``_pl``/``_pr``."""
    lsrc = F.when(F.col("_side") == 0, F.col("_l")).otherwise(F.col("_pl"))
    rsrc = F.when(F.col("_side") == 1, F.col("_r")).otherwise(F.col("_pr"))
    return (b.filter("_closes")
             .select(*keys, lsrc.alias("_ml"), rsrc.alias("_mr"))
             .select(*keys, *[F.col(f"_ml.{c}").alias(lp + c) for c in lcols],
                     *[F.col(f"_mr.{c}").alias(rp + c) for c in rcols]))
