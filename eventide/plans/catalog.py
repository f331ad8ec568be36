"""Registry of queries over the driver tables, with their DuckDB oracle SQL.

Every query reads whole tables.  Time columns are emitted as BIGINT epoch
milliseconds (``window_end``) so Spark and DuckDB agree on types; DuckDB's
``epoch_ms`` rounds, so the oracle uses ``epoch_us(ts) // 1000`` (floor), like
Spark's ``unix_millis``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import to_event_time
from eventide.operators.distinct import bitmap_distinct_per_window, merge_bitmaps
from eventide.plans import jobs
from eventide.sources import parse_access_log, parse_csv, schemas
from eventide.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]

# three standard errors of a sketch of 2^12 registers (1.04 / 64 each)
HLL_ERROR = 3 * 1.04 / 64


def _behavior(spark, sf):
    return T.as_user_behavior(T.events(spark, sf))


def q_page_views(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.page_views(_behavior(spark, sf), "1 hour", pv=T.VIEW)


def q_hot_items(spark, sf):
    return jobs.hot_items(_behavior(spark, sf), 3, "1 hour", "5 minutes", pv=T.VIEW)


def q_hot_items_avg_ts(spark, sf):
    return jobs.hot_items(_behavior(spark, sf), 3, "1 hour", "5 minutes", metric="avg_ts", pv=T.VIEW)


def q_hot_items_report(spark, sf):
    return jobs.hot_items_report(_behavior(spark, sf), 3, "1 hour", "5 minutes", pv=T.VIEW)


def q_unique_visitors(spark, sf):
    return jobs.unique_visitors(_behavior(spark, sf), "1 hour", pv=T.VIEW)


def q_unique_visitors_sliding(spark, sf):
    return jobs.unique_visitors_sliding(_behavior(spark, sf), "1 hour", "5 minutes", pv=T.VIEW)


def q_unique_visitors_hll(spark, sf):
    return jobs.unique_visitors_approx(_behavior(spark, sf), "1 hour", pv=T.VIEW)


def q_unique_visitors_hll_error(spark, sf):
    """Exact count per window, and whether the sketch stays within 3 standard errors of it."""
    views = _behavior(spark, sf)
    exact = jobs.unique_visitors(views, "1 hour", pv=T.VIEW)
    sketch = jobs.unique_visitors_approx(views, "1 hour", pv=T.VIEW).withColumnRenamed("uv", "estimate")
    error = F.abs(F.col("estimate") - F.col("uv"))
    return exact.join(sketch, "window_end").select(
        "window_end", "uv", (error <= F.greatest(F.lit(1.0), HLL_ERROR * F.col("uv"))).alias("within_error"))


def q_unique_visitors_bitmap_daily(spark, sf):
    """Hourly bitmaps merged to daily counts: what a stored bitmap table is kept for."""
    views = _behavior(spark, sf).filter(F.col("behavior") == T.VIEW)
    hourly = bitmap_distinct_per_window(views, "user_id", "1 hour", keep_bitmaps=True)
    start = F.col("window_end") - 3_600_000
    day_end = start - F.pmod(start, F.lit(86_400_000)) + 86_400_000
    return merge_bitmaps(hourly.withColumn("window_end", day_end))


def q_unique_visitors_bitmap(spark, sf):
    return jobs.unique_visitors_bitmap(_behavior(spark, sf), "1 hour", pv=T.VIEW)


def q_unique_visitors_running(spark, sf):
    return jobs.unique_visitors_running(_behavior(spark, sf), "1 hour", pv=T.VIEW)


def _marketing(spark, sf):
    return T.as_marketing(T.events(spark, sf))


def q_marketing_total(spark, sf):
    return jobs.marketing_total(_marketing(spark, sf), "1 hour", "10 seconds", exclude="error")


def q_marketing_by_channel(spark, sf):
    return jobs.marketing_by_channel(_marketing(spark, sf), "1 hour", "10 seconds", exclude="error")


def q_top_urls(spark, sf):
    return jobs.top_urls(T.as_access_log(T.events(spark, sf)), 5, "10 minutes", "5 seconds")


def q_access_log_top_urls(spark, sf):
    # the events as text lines, read back by the access log's parser
    log = parse_access_log(T.access_log_lines(T.events(spark, sf)))
    return jobs.top_urls(log, 5, "10 minutes", "5 seconds")


def q_csv_page_views(spark, sf):
    rows = parse_csv(T.behavior_lines(T.events(spark, sf)), schemas.USER_BEHAVIOR, trim=True)
    return jobs.page_views(to_event_time(rows, "ts_s", "s"), pv=T.VIEW)


def q_csv_marketing_total(spark, sf):
    rows = parse_csv(T.marketing_lines(T.events(spark, sf)), schemas.MARKETING)
    return jobs.marketing_total(to_event_time(rows, "ts_ms", "ms"), exclude=T.ERROR)


def q_top_urls_late(spark, sf):
    # arrival: every eight events in reverse order
    log = T.as_access_log(T.events(spark, sf)).withColumn("arrival", F.expr("seq + 7 - 2 * (seq % 8)"))
    return jobs.top_urls(log, 5, "10 minutes", "5 seconds", delay="5 seconds", lateness="60 seconds",
                         arrival="arrival")


def q_top_urls_report(spark, sf):
    return jobs.top_urls_report(T.as_access_log(T.events(spark, sf)), 5, "10 minutes", "5 seconds")


# ---- Q7 -------------------------------------------------------------------------------
AD_CAP = 10  # per-user clicks in the driver table are at most ~30, so 100 would never bind
AD_DAILY_CAP = 1  # a user clicks at most a few times a day; 1 per day binds on many days


def _ads(spark, sf, reset="never"):
    cap = AD_CAP if reset == "never" else AD_DAILY_CAP
    return jobs.ad_clicks_by_province(T.as_ad_clicks(T.events(spark, sf)), cap=cap,
                                      size="1 hour", keys=["user_id"], reset=reset)


def q_ad_clicks_by_province(spark, sf):
    return _ads(spark, sf).province_counts


def q_ad_blacklist(spark, sf):
    return _ads(spark, sf).warnings


def q_ad_clicks_by_province_daily(spark, sf):
    return _ads(spark, sf, "event_day").province_counts


def q_ad_blacklist_daily(spark, sf):
    return _ads(spark, sf, "event_day").warnings


# ---- Q8 -------------------------------------------------------------------------------
def q_login_failures(spark, sf):
    return jobs.login_failures(T.as_logins(T.events(spark, sf)), "1 day", keyed=True)


def q_login_failures_unkeyed(spark, sf):
    return jobs.login_failures(T.as_logins(T.events(spark, sf)), "10 minutes", keyed=False)


# ---- Q9 -------------------------------------------------------------------------------
def _orders(spark, sf):
    return jobs.order_timeout(T.as_order_events(T.events(spark, sf)), "12 hours",
                             create=T.VIEW, pay=T.PURCHASE)


def q_order_paid(spark, sf):
    return _orders(spark, sf).paid


def q_order_timeout(spark, sf):
    return _orders(spark, sf).timed_out


# ---- Q10 ------------------------------------------------------------------------------
def _receipts(spark, sf, timeout=None):
    ev = T.events(spark, sf)
    return jobs.receipt_match(T.as_pays(ev).drop("event_id"), T.as_receipts(ev).drop("event_id"),
                              timeout=timeout)


def q_receipt_matched(spark, sf):
    return _receipts(spark, sf).matched.select("pay_id", "pay_seq", "receipt_seq")


def q_receipt_unmatched_pays(spark, sf):
    return _receipts(spark, sf).left_only.select("pay_id", "pay_seq", "reason")


def q_receipt_unmatched_receipts(spark, sf):
    return _receipts(spark, sf).right_only.select("pay_id", "receipt_seq", "reason")


def q_receipt_overwritten(spark, sf):
    return _receipts(spark, sf).overwritten.select("pay_id", "side", "seq")


def q_receipt_matched_timeout(spark, sf):
    return _receipts(spark, sf, "1 hour").matched.select("pay_id", "pay_seq", "receipt_seq")


def q_receipt_unmatched_pays_timeout(spark, sf):
    return _receipts(spark, sf, "1 hour").left_only.select("pay_id", "pay_seq", "reason")


def q_receipt_unmatched_receipts_timeout(spark, sf):
    return _receipts(spark, sf, "1 hour").right_only.select("pay_id", "receipt_seq", "reason")


# ---- Q11 ------------------------------------------------------------------------------
def q_interval_join(spark, sf):
    ev = T.events(spark, sf)
    clicks = (ev.filter("event_type = 'click'").select(F.col("user_id").alias("pay_id"), "ts", "seq"))
    pays = T.as_pays(ev).drop("event_id")
    return (jobs.receipt_interval_join(pays, clicks, "-1 hour", "1 hour")
            .select(F.col("pay_id").alias("user_id"), "pay_seq", F.col("receipt_seq").alias("click_seq")))


def q_interval_join_orders(spark, sf):
    from eventide.functions.time import to_event_time
    from eventide.operators.joins import interval_join
    o = to_event_time(T.read_table(spark, sf, "orders"), "o_orderdate", out="ts") \
        .select(F.col("o_orderkey").alias("orderkey"), "ts", "o_custkey")
    l = to_event_time(T.read_table(spark, sf, "lineitem"), "l_shipdate", out="ts") \
        .select(F.col("l_orderkey").alias("orderkey"), "ts", "l_linenumber", "l_partkey")
    return (interval_join(o, l, "orderkey", "-15 days", "15 days", left_prefix="o_", right_prefix="l_")
            .select(F.col("orderkey").alias("o_orderkey"), "o_o_custkey", "l_l_linenumber", "l_l_partkey",
                    F.unix_millis("o_ts").alias("o_ms"), F.unix_millis("l_ts").alias("l_ms"))
            .withColumnRenamed("o_o_custkey", "o_custkey")
            .withColumnRenamed("l_l_linenumber", "l_linenumber")
            .withColumnRenamed("l_l_partkey", "l_partkey"))


# ---- late data (E6, E7): orders arrive in o_orderkey order, dates are not ordered ---------
LATE_DELAY_DAYS, LATE_LATENESS_DAYS = 365, 30


def _orders_arrival(spark, sf):
    from eventide.functions.time import to_event_time
    o = to_event_time(T.read_table(spark, sf, "orders"), "o_orderdate", out="ts")
    return o.select("o_orderkey", "o_orderpriority", "ts", F.col("o_orderkey").alias("seq"))


def q_late_orders(spark, sf):
    from eventide.operators.late import late_rows
    return (late_rows(_orders_arrival(spark, sf), "ts", "seq", f"{LATE_DELAY_DAYS} days")
            .select("o_orderkey", F.unix_millis("ts").alias("o_ms"), "wm_ms"))


def q_order_counts_late(spark, sf):
    from eventide.operators.aggs import Count
    from eventide.operators.late import admit_from
    from eventide.operators.windows import sliding_agg
    o = admit_from(_orders_arrival(spark, sf), "ts", "seq", f"{LATE_DELAY_DAYS} days",
                   f"{LATE_LATENESS_DAYS} days")
    return sliding_agg(o, "90 days", "30 days", [Count("cnt")], keys=["o_orderpriority"], admit="admit_ms")


# ---------------------------------------------------------------------------------------
# DuckDB oracle SQL.  `E` is the events table with ms / us time and k.
E = """(select *, epoch_us(ts) as us, epoch_us(ts) // 1000 as ms,
           cast(json_extract(props, '$.k') as bigint) as k from events)"""

# the reference's bitmap offset: base-61 polynomial hash of the decimal text, mod 2^29
HASH = ("list_reduce(list_transform(string_split(cast({c} as varchar), ''), lambda x: ascii(x)::BIGINT), "
        "lambda a, b: (a * 61 + b) % 536870912)")

# The reference's hot-items report labels (see functions.text)
_TS_TEXT = "strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0'"


def _sliding(key_cols: str, size_ms: int, slide_ms: int, where: str, agg: str = "count(*) as cnt",
             start: bool = False, src: str = E) -> str:
    n = size_ms // slide_ms
    we = f"ms - ms % {slide_ms} + (u.j + 1) * {slide_ms}"
    ws = f"{we} - {size_ms} as window_start, " if start else ""
    keys = f"{key_cols}, " if key_cols else ""
    return f"""select {keys}{ws}{we} as window_end, {agg}
        from {src} e, range({n}) u(j) where {where} group by all"""


def _top(counts: str, n: int, key: str, metric: str = "cnt") -> str:
    return f"""with c as ({counts}),
        r as (select *, row_number() over (partition by window_end order by {metric} desc, {key}) as rank
              from c)
        select window_end, rank, {key}, {metric} from r where rank <= {n}"""


def _report(top: str, key: str, label: str, footer: str) -> str:
    return f"""with t as ({top})
        select window_end,
               '时间：' || {_TS_TEXT} || chr(10)
               || string_agg('No' || rank || ':' || '{label}' || {key} || ' 浏览量=' || cnt || chr(10), ''
                             order by rank)
               || '{footer}' as report
        from t group by window_end"""


_HOT = _top(_sliding("k as item_id", 3_600_000, 300_000, "event_type = 'view'"), 3, "item_id")
_HOT_AVG = _top(_sliding("k as item_id", 3_600_000, 300_000, "event_type = 'view'",
                         "cast(sum(us // 1000000) // count(*) as bigint) as cnt"), 3, "item_id")
_URLS = _top(_sliding("'/item/' || k as url", 600_000, 5_000, "true"), 5, "url")
_ARRIVED = f"""(select *, max(ms) over (order by event_id + 7 - 2 * (event_id % 8)
                                        rows between unbounded preceding and 1 preceding) - 5000 as wm
               from {E} x)"""
_URLS_LATE = _top(_sliding("'/item/' || k as url", 600_000, 5_000,
                           "(wm is null or ms - ms % 5000 + (u.j + 1) * 5000 > wm - 60000)", src=_ARRIVED), 5, "url")
_VIEWS = f"""(select *, ms - ms % 3600000 + 3600000 as window_end from {E} x
             where event_type = 'view')"""

_CLICKS = f"""(select *, row_number() over (partition by user_id order by us, event_id) as r
               from {E} x where event_type = 'click')"""
_CLICKS_DAY = f"""(select *, row_number() over (partition by user_id, ms - ms % 86400000
                                                order by us, event_id) as r
                   from {E} x where event_type = 'click')"""


def _province(c, cap=AD_CAP):
    return f"""select cast(k % 10 as varchar) as province, ms - ms % 3600000 + 3600000 as window_end,
               count(*) as cnt from {c} c where r <= {cap} group by all"""


def _blacklist(c, cap=AD_CAP):
    return f"select user_id, event_id as seq, 'Input blacklist' as msg from {c} c where r = {cap + 1}"


def _login(part: str, within_us: int) -> str:
    return f"""select user_id, first_seq, second_seq, first_time, last_time,
               'two time next fail to login' as msg from (
          select user_id, event_type as a, event_id as first_seq, us, us // 1000000 as first_time,
                 lead(event_type) over w as b, lead(event_id) over w as second_seq,
                 lead(us) over w as us2, lead(us) over w // 1000000 as last_time
          from {E} x window w as ({part} order by us, event_id))
        where a = 'error' and b = 'error' and us2 - us < {within_us}"""


_ORDERS = f"""(select user_id as order_id, event_id as create_seq, us,
        first_value(case when event_type = 'purchase' then event_id end ignore nulls) over w as pay_seq,
        first_value(case when event_type = 'purchase' then us end ignore nulls) over w as pay_us,
        event_type
     from {E} x
     window w as (partition by user_id order by us, event_id
                  rows between 1 following and unbounded following))"""


def _pairs(timeout_us: int | None) -> str:
    gap_brk = f" or us - lag(us) over w > {timeout_us}" if timeout_us else ""
    ngap = f"lead(us) over w - us" if timeout_us else "0"
    return f"""(with x as (select user_id as pay_id, case when event_type = 'purchase' then 0 else 1 end as side,
                         us, event_id as seq from {E} e where event_type in ('purchase', 'signup')),
      a as (select *, case when lag(side) over w is null or side = lag(side) over w{gap_brk}
                           then 1 else 0 end as brk,
                   row_number() over w as rn, lag(seq) over w as pseq, lead(side) over w as nside,
                   {ngap} as ngap
            from x window w as (partition by pay_id order by us, seq, side)),
      b as (select *, rn - max(case when brk = 1 then rn end) over
                      (partition by pay_id order by us, seq, side rows unbounded preceding) + 1 as pos,
                   lead(brk) over (partition by pay_id order by us, seq, side) as nbrk from a)
      select *, pos % 2 = 0 as closes,
             pos % 2 = 1 and coalesce(nbrk, 1) = 1 as pending,
             pos % 2 = 1 and coalesce(nbrk, 1) = 1 and nside is not null and nside = side
               {f"and ngap <= {timeout_us}" if timeout_us else ""} as over
      from b)"""


def _matched(p):
    return f"""select pay_id, case when side = 0 then seq else pseq end as pay_seq,
                      case when side = 1 then seq else pseq end as receipt_seq from {p} p where closes"""


def _unmatched(p, side, name):
    return f"""select pay_id, seq as {name}, case when nside is null then 'end' else 'timeout' end as reason
               from {p} p where pending and not over and side = {side}"""


_O_LATE = f"""(select o_orderkey, o_orderpriority, epoch_us(o_orderdate) // 1000 as ms,
        max(epoch_us(o_orderdate) // 1000) over (order by o_orderkey rows between unbounded preceding
                                                  and 1 preceding) - {LATE_DELAY_DAYS * 86_400_000} as wm
     from orders)"""

SQL = {
    "page_views": f"""
        select ms - ms % 3600000 + 3600000 as window_end, count(*) as pv
        from {E} e where event_type = 'view' group by 1""",
    "hot_items": _HOT,
    "hot_items_avg_ts": _HOT_AVG,
    "hot_items_report": _report(_HOT, "item_id", " 商品ID=", "=" * 24),
    "unique_visitors": f"""
        select window_end, count(distinct user_id) as uv from {_VIEWS} v group by 1""",
    "unique_visitors_sliding": f"""
        select window_end, count(distinct user_id) as uv from (
          select user_id, ms - ms % 300000 + (u.j + 1) * 300000 as window_end
          from {E} e, range(12) u(j) where event_type = 'view') group by 1""",
    "unique_visitors_hll_error": f"""
        select window_end, count(distinct user_id) as uv, true as within_error from {_VIEWS} v group by 1""",
    "unique_visitors_bitmap": f"""
        select window_end, count(distinct {HASH.format(c="user_id")}) as uv from {_VIEWS} v group by 1""",
    "unique_visitors_bitmap_daily": f"""
        select ms - ms % 86400000 + 86400000 as window_end, count(distinct {HASH.format(c="user_id")}) as uv
        from {_VIEWS} v group by 1""",
    "unique_visitors_running": f"""
        with b as (select event_id as seq, window_end, us, {HASH.format(c="user_id")} as o from {_VIEWS} v),
        f as (select *, case when row_number() over (partition by window_end, o order by us, seq) = 1
                             then 1 else 0 end as new from b)
        select seq, window_end,
               cast(sum(new) over (partition by window_end order by us, seq rows unbounded preceding)
                    as bigint) as uv
        from f""",
    "marketing_total": _sliding("", 3_600_000, 10_000, "event_type <> 'error'", start=True),
    "marketing_by_channel": _sliding(
        "event_type as behavior, 'channel_' || (k % 5) as channel",
        3_600_000, 10_000, "event_type <> 'error'", start=True),
    "top_urls": _URLS,
    "access_log_top_urls": _URLS,
    "top_urls_late": _URLS_LATE,
    "top_urls_report": _report(_URLS, "url", " url=", "=" * 28),
    "ad_clicks_by_province": _province(_CLICKS),
    "ad_blacklist": _blacklist(_CLICKS),
    "ad_clicks_by_province_daily": _province(_CLICKS_DAY, AD_DAILY_CAP),
    "ad_blacklist_daily": _blacklist(_CLICKS_DAY, AD_DAILY_CAP),
    "login_failures": _login("partition by user_id", 86_400_000_000),
    "login_failures_unkeyed": _login("", 600_000_000),
    "order_paid": f"""select order_id, create_seq, pay_seq, 'pay success' as msg from {_ORDERS} o
        where event_type = 'view' and pay_us - us < 43200000000""",
    "order_timeout": f"""select order_id, create_seq, 'pay timeout' as msg from {_ORDERS} o
        where event_type = 'view' and (pay_us is null or pay_us - us >= 43200000000)""",
    "receipt_matched": _matched(_pairs(None)),
    "receipt_unmatched_pays": _unmatched(_pairs(None), 0, "pay_seq"),
    "receipt_unmatched_receipts": _unmatched(_pairs(None), 1, "receipt_seq"),
    "receipt_overwritten": f"""select pay_id, case when side = 0 then 'left' else 'right' end as side, seq
        from {_pairs(None)} p where over""",
    "receipt_matched_timeout": _matched(_pairs(3_600_000_000)),
    "receipt_unmatched_pays_timeout": _unmatched(_pairs(3_600_000_000), 0, "pay_seq"),
    "receipt_unmatched_receipts_timeout": _unmatched(_pairs(3_600_000_000), 1, "receipt_seq"),
    "interval_join": f"""select p.user_id, p.event_id as pay_seq, c.event_id as click_seq
        from {E} p join {E} c on p.user_id = c.user_id
         and c.us between p.us - 3600000000 and p.us + 3600000000
        where p.event_type = 'purchase' and c.event_type = 'click'""",
    "late_orders": f"select o_orderkey, ms as o_ms, wm as wm_ms from {_O_LATE} o where ms < wm",
    "order_counts_late": f"""select o_orderpriority, window_end, count(*) as cnt from (
          select o_orderpriority, ms - ms % 2592000000 + (u.j + 1) * 2592000000 as window_end, wm
          from {_O_LATE} o, range(3) u(j))
        where wm is null or window_end - 1 + {LATE_LATENESS_DAYS * 86_400_000} > wm group by all""",
    "interval_join_orders": """select o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey,
               epoch_us(o.o_orderdate) // 1000 as o_ms, epoch_us(l.l_shipdate) // 1000 as l_ms
        from orders o join lineitem l on o.o_orderkey = l.l_orderkey
         and l.l_shipdate between o.o_orderdate - interval 15 day and o.o_orderdate + interval 15 day""",
}

SQL["csv_page_views"] = SQL["page_views"]
SQL["csv_marketing_total"] = SQL["marketing_total"]

QUERIES: dict[str, Query] = {
    "page_views": q_page_views,
    "hot_items": q_hot_items,
    "hot_items_avg_ts": q_hot_items_avg_ts,
    "hot_items_report": q_hot_items_report,
    "unique_visitors": q_unique_visitors,
    "unique_visitors_sliding": q_unique_visitors_sliding,
    "unique_visitors_hll": q_unique_visitors_hll,
    "unique_visitors_hll_error": q_unique_visitors_hll_error,
    "unique_visitors_bitmap": q_unique_visitors_bitmap,
    "unique_visitors_bitmap_daily": q_unique_visitors_bitmap_daily,
    "unique_visitors_running": q_unique_visitors_running,
    "marketing_total": q_marketing_total,
    "marketing_by_channel": q_marketing_by_channel,
    "top_urls": q_top_urls,
    "access_log_top_urls": q_access_log_top_urls,
    "csv_page_views": q_csv_page_views,
    "csv_marketing_total": q_csv_marketing_total,
    "top_urls_late": q_top_urls_late,
    "top_urls_report": q_top_urls_report,
    "ad_clicks_by_province": q_ad_clicks_by_province,
    "ad_blacklist": q_ad_blacklist,
    "ad_clicks_by_province_daily": q_ad_clicks_by_province_daily,
    "ad_blacklist_daily": q_ad_blacklist_daily,
    "login_failures": q_login_failures,
    "login_failures_unkeyed": q_login_failures_unkeyed,
    "order_paid": q_order_paid,
    "order_timeout": q_order_timeout,
    "receipt_matched": q_receipt_matched,
    "receipt_unmatched_pays": q_receipt_unmatched_pays,
    "receipt_unmatched_receipts": q_receipt_unmatched_receipts,
    "receipt_overwritten": q_receipt_overwritten,
    "receipt_matched_timeout": q_receipt_matched_timeout,
    "receipt_unmatched_pays_timeout": q_receipt_unmatched_pays_timeout,
    "receipt_unmatched_receipts_timeout": q_receipt_unmatched_receipts_timeout,
    "interval_join": q_interval_join,
    "interval_join_orders": q_interval_join_orders,
    "late_orders": q_late_orders,
    "order_counts_late": q_order_counts_late,
}
