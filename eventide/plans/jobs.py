"""The reference's jobs as DataFrame plans.

Each job takes DataFrames in the reference's record shapes (see
``eventide.sources``) and returns DataFrames; jobs with side outputs return a
NamedTuple of DataFrames.  Parameters default to the reference's values.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.text import URL_FOOTER, URL_LABEL, format_ranking
from eventide.operators.aggs import Count, IntAvg
from eventide.operators.distinct import (
    approx_distinct_per_window, bitmap_distinct_per_window, distinct_per_window, running_distinct,
)
from eventide.operators.joins import PairResult, interval_join, pair_one_to_one, pair_outcome
from eventide.operators.late import admit_from
from eventide.operators.limits import cap_outcome, cap_per_key
from eventide.operators.patterns import followed_by, followed_by_outcome, strict_pairs
from eventide.operators.topn import sliding_top_n
from eventide.operators.windows import sliding_agg, tumbling_agg, tumbling_end


def page_views(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Q2: ``pv`` events per tumbling window -> window_end, pv (BIGINT)."""
    return tumbling_agg(behavior.filter(F.col("behavior") == pv), size, [Count("pv")])


# ---- Q1 hot items ---------------------------------------------------------------------

def item_counts(behavior: DataFrame, size="1 hour", slide="5 minutes", metric: str = "count",
                pv: str = "pv") -> DataFrame:
    """Per (item, sliding window): ``cnt`` = number of views (``metric="count"``), or the
    reference's as-shipped ``metric="avg_ts"`` = integer average of the epoch-second time."""
    if metric not in ("count", "avg_ts"):
        raise ValueError("metric must be 'count' or 'avg_ts'")
    agg = Count("cnt") if metric == "count" else IntAvg("cnt", "ts_s")
    return sliding_agg(behavior.filter(F.col("behavior") == pv), size, slide, [agg], keys=["item_id"])


def _hot_items(behavior, n, size, slide, metric, pv, salts):
    if metric not in ("count", "avg_ts"):
        raise ValueError("metric must be 'count' or 'avg_ts'")
    agg = Count("cnt") if metric == "count" else IntAvg("cnt", "ts_s")
    return sliding_top_n(behavior.filter(F.col("behavior") == pv), size, slide, [agg], "item_id", n, "cnt",
                         salts=salts)


def hot_items(behavior: DataFrame, n: int = 3, size="1 hour", slide="5 minutes",
              metric: str = "count", pv: str = "pv", salts: int | None = None) -> DataFrame:
    """Q1: top ``n`` items per sliding window -> window_end, rank, item_id, cnt."""
    return _hot_items(behavior, n, size, slide, metric, pv, salts).select("window_end", "rank", "item_id", "cnt")


def hot_items_report(behavior: DataFrame, n: int = 3, size="1 hour", slide="5 minutes",
                     metric: str = "count", pv: str = "pv", salts: int | None = None) -> DataFrame:
    """Q1 as text: one ranking report per window (T3) -> window_end, report."""
    return format_ranking(_hot_items(behavior, n, size, slide, metric, pv, salts), "item_id", "cnt",
                          group_extra=["_bkt"])


# ---- Q3 / Q4 unique visitors ----------------------------------------------------------

def unique_visitors(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Q3: exact distinct users per tumbling window -> window_end, uv."""
    return distinct_per_window(behavior.filter(F.col("behavior") == pv), "user_id", size)


def unique_visitors_sliding(behavior: DataFrame, size="1 hour", slide="5 minutes", pv: str = "pv") -> DataFrame:
    """Exact distinct users per sliding window (panes deduplicated first) -> window_end, uv."""
    return distinct_per_window(behavior.filter(F.col("behavior") == pv), "user_id", size, slide)


def unique_visitors_approx(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Q4 with a standard sketch (A6): HLL estimate per window -> window_end, uv."""
    return approx_distinct_per_window(behavior.filter(F.col("behavior") == pv), "user_id", size)


def unique_visitors_bitmap(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Q4 final counts: distinct bitmap offsets per window (A7) -> window_end, uv."""
    return bitmap_distinct_per_window(behavior.filter(F.col("behavior") == pv), "user_id", size)


def unique_visitors_running(behavior: DataFrame, size="1 hour", pv: str = "pv",
                            hashed: bool = True) -> DataFrame:
    """Q4 as shipped: one row per view with the window's distinct count so far
    -> seq, window_end, uv."""
    return running_distinct(behavior.filter(F.col("behavior") == pv), "user_id", size, hashed=hashed)


# ---- Q5 / Q6 marketing ----------------------------------------------------------------

def _text_bounds(df: DataFrame, text: bool) -> DataFrame:
    # the reference's records carry window bounds as strings of epoch ms
    if not text:
        return df
    return (df.withColumn("window_start", F.col("window_start").cast("string"))
              .withColumn("window_end", F.col("window_end").cast("string")))


def marketing_total(marketing: DataFrame, size="1 hour", slide="10 seconds",
                    exclude: str = "UNINSTALL", text_bounds: bool = False) -> DataFrame:
    """Q5: events per sliding window, ``behavior != exclude`` -> window_start, window_end, cnt."""
    return _text_bounds(sliding_agg(marketing.filter(F.col("behavior") != exclude), size, slide,
                                    [Count("cnt")], with_start=True), text_bounds)


def marketing_by_channel(marketing: DataFrame, size="1 hour", slide="10 seconds",
                         exclude: str = "UNINSTALL", text_bounds: bool = False) -> DataFrame:
    """Q6: the same per (behavior, channel) -> behavior, channel, window_start, window_end, cnt."""
    return _text_bounds(sliding_agg(marketing.filter(F.col("behavior") != exclude), size, slide,
                                    [Count("cnt")], keys=["behavior", "channel"], with_start=True),
                        text_bounds)


# ---- Q12 hot URLs ---------------------------------------------------------------------

def url_counts(log: DataFrame, size="10 minutes", slide="5 seconds") -> DataFrame:
    return sliding_agg(log, size, slide, [Count("cnt")], keys=["url"])


def _late_log(log, delay, lateness, arrival):
    if delay is None:
        return log, None
    return admit_from(log, "ts", arrival, delay, lateness or "0 seconds"), "admit_ms"


def top_urls(log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds", delay=None,
             lateness=None, arrival: str = "seq", salts: int | None = None) -> DataFrame:
    """Q12: top ``n`` URLs per sliding window -> window_end, rank, url, cnt.

    Without ``delay`` every row counts (the final answer once all late rows are in).
    With the reference's ``delay="5 seconds", lateness="60 seconds"`` a row counts only
    in windows that were still open when it arrived (in ``arrival`` order)."""
    log, admit = _late_log(log, delay, lateness, arrival)
    return sliding_top_n(log, size, slide, [Count("cnt")], "url", n, "cnt", admit=admit, salts=salts) \
        .select("window_end", "rank", "url", "cnt")


def top_urls_report(log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds", delay=None,
                    lateness=None, arrival: str = "seq", salts: int | None = None) -> DataFrame:
    log, admit = _late_log(log, delay, lateness, arrival)
    ranked = sliding_top_n(log, size, slide, [Count("cnt")], "url", n, "cnt", admit=admit, salts=salts)
    return format_ranking(ranked, "url", "cnt", key_label=URL_LABEL, footer=URL_FOOTER,
                          group_extra=["_bkt"])


# ---- Q7 ad clicks with a blacklist ----------------------------------------------------

class AdReport(NamedTuple):
    province_counts: DataFrame  # province, window_end, cnt
    warnings: DataFrame         # keys, seq, msg


def ad_clicks_by_province(clicks: DataFrame, cap: int = 100, size="1 hour",
                          keys=("user_id", "ad_id"), reset: str = "never") -> AdReport:
    """Q7: cap clicks per (user, ad) at ``cap`` (one warning at the first refused click),
    then count the kept clicks per province and tumbling window."""
    capped = cap_per_key(clicks, list(keys), cap, reset=reset)
    counts = tumbling_agg(capped.kept, size, [Count("cnt")], keys=["province"])
    return AdReport(counts, capped.warnings.select(*keys, "seq", "msg"))


# ---- Q8 login failures ----------------------------------------------------------------

# Fixed value: the reference's message for two consecutive failures.
LOGIN_FAIL_MSG = "two time next fail to login"


def login_failures(logins: DataFrame, within="2 seconds", keyed: bool = True,
                   fail: str = "fail", bucket=None) -> DataFrame:
    """Q8: two consecutive failed logins less than ``within`` apart
    -> user_id, first_seq, second_seq, first_time, last_time (epoch s), msg.

    ``keyed=False`` is the reference as shipped: consecutive over all users, reported
    under the first failure's user."""
    is_fail = F.col("event_type") == fail
    return login_report(strict_pairs(logins, is_fail, is_fail, within, bucket=bucket,
                                     keys=["user_id"] if keyed else [], carry=[] if keyed else ["user_id"]), keyed)


def login_report(pairs: DataFrame, keyed: bool) -> DataFrame:
    """Q8's columns from the matched pairs."""
    user = F.col("user_id") if keyed else F.col("first_user_id").alias("user_id")
    return pairs.select(user, "first_seq", "second_seq",
                        F.unix_seconds("first_ts").alias("first_time"),
                        F.unix_seconds("second_ts").alias("last_time"),
                        F.lit(LOGIN_FAIL_MSG).alias("msg"))


# ---- Q9 order pay timeout -------------------------------------------------------------

# The reference's result messages.
PAY_SUCCESS_MSG = "pay success"
PAY_TIMEOUT_MSG = "pay timeout"


class PayOutcome(NamedTuple):
    paid: DataFrame       # order_id, create_seq, pay_seq, msg
    timed_out: DataFrame  # order_id, create_seq, msg


def order_timeout(orders: DataFrame, within="15 minutes", create: str = "create",
                  pay: str = "pay", bucket=None) -> PayOutcome:
    """Q9: each create takes the first later pay of the same order; paid if less than
    ``within`` later, else (or when no pay follows) timed out.  ``bucket``: time span of a
    hot key that one task holds (default four times ``within``)."""
    res = followed_by(orders, F.col("pay_status") == create, F.col("pay_status") == pay,
                      within, keys=["order_id"], bucket=bucket)
    return order_report(res.matched, res.timed_out)


def order_report(matched: DataFrame, timed_out: DataFrame) -> PayOutcome:
    """Q9's columns from the pattern's matched and timed-out rows."""
    paid = matched.select("order_id", F.col("begin_seq").alias("create_seq"),
                          F.col("follow_seq").alias("pay_seq"), F.lit(PAY_SUCCESS_MSG).alias("msg"))
    late = timed_out.select("order_id", F.col("begin_seq").alias("create_seq"), F.lit(PAY_TIMEOUT_MSG).alias("msg"))
    return PayOutcome(paid, late)


# ---- Q10 / Q11 payments and receipts --------------------------------------------------

def receipt_match(pays: DataFrame, receipts: DataFrame, timeout=None, key: str = "pay_id",
                  bucket="1 hour") -> PairResult:
    """Q10: one-to-one pairing of payments and receipts by pay id; pending rows that are
    never closed come out as unmatched pays / receipts (with ``timeout``: once it passes).
    ``bucket``: time span of a hot key that one task holds."""
    return pair_one_to_one(pays, receipts, key, timeout=timeout, bucket=bucket,
                           left_prefix="pay_", right_prefix="receipt_")


def receipt_interval_join(pays: DataFrame, receipts: DataFrame, lower="-15 seconds",
                          upper="15 seconds", key: str = "pay_id", bucket="auto") -> DataFrame:
    """Q11: every (pay, receipt) of the same pay id with
    ``pay.ts + lower <= receipt.ts <= pay.ts + upper``."""
    return interval_join(pays, receipts, key, lower, upper, left_prefix="pay_",
                         right_prefix="receipt_", bucket=bucket)


# ---- several outputs in one pass ------------------------------------------------------

class Outcome(NamedTuple):
    """A job with side outputs as one frame (S10): ``branch`` names a row's output, ``branches``
    gives each output's columns (the others are null in its rows)."""
    frame: DataFrame
    branches: dict[str, list[str]]


def ad_outcome(clicks: DataFrame, cap: int = 100, size="1 hour", keys=("user_id", "ad_id"),
               reset: str = "never") -> Outcome:
    """Q7 in one pass: the kept clicks' province counts and the warnings, by one aggregate."""
    keys = list(keys)
    capped = cap_outcome(clicks, keys, cap, reset=reset)
    kept = F.col("branch") == "kept"
    own = [F.when(~kept, F.col(c)).alias(c) for c in (*keys, "seq", "msg")]
    rows = capped.select(F.when(kept, "province_counts").otherwise("warnings").alias("branch"),
                         F.when(kept, F.col("province")).alias("province"),
                         F.when(kept, tumbling_end("ts", size)).alias("window_end"), *own)
    frame = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("cnt"))
    return Outcome(frame, {"province_counts": ["province", "window_end", "cnt"], "warnings": [*keys, "seq", "msg"]})


def order_outcome(orders: DataFrame, within="15 minutes", create: str = "create", pay: str = "pay", bucket=None) -> Outcome:
    """Q9 in one pass."""
    found = followed_by_outcome(orders, F.col("pay_status") == create, F.col("pay_status") == pay, within,
                                keys=["order_id"], bucket=bucket)
    paid = F.col("branch") == "matched"
    frame = found.select("order_id", F.col("begin_seq").alias("create_seq"), F.col("follow_seq").alias("pay_seq"),
                         F.when(paid, F.lit(PAY_SUCCESS_MSG)).otherwise(F.lit(PAY_TIMEOUT_MSG)).alias("msg"),
                         F.when(paid, F.lit("paid")).otherwise(F.lit("timed_out")).alias("branch"))
    return Outcome(frame, {"paid": ["order_id", "create_seq", "pay_seq", "msg"], "timed_out": ["order_id", "create_seq", "msg"]})


def receipt_outcome(pays: DataFrame, receipts: DataFrame, timeout=None, key: str = "pay_id", bucket="1 hour") -> Outcome:
    """Q10 in one pass."""
    frame = pair_outcome(pays, receipts, key, timeout=timeout, bucket=bucket, left_prefix="pay_", right_prefix="receipt_")
    left = ["pay_" + c for c in pays.columns if c != key]
    right = ["receipt_" + c for c in receipts.columns if c != key]
    return Outcome(frame, {"matched": [key, *left, *right], "left_only": [key, *left, "reason"],
                           "right_only": [key, *right, "reason"], "overwritten": [key, "side", "ts", "seq"]})
