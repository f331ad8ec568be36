"""Driver tables (parquet) and their mapping to the reference's record shapes.

The ``events`` table (event_id, ts timestamp_ntz, user_id, event_type, value,
props ``{"k": n}``) stands in for every behaviour log.  The mappings below are
plain projections and predicates, so Catalyst prunes columns and pushes the
event-type filters into the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import to_event_time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Labels of the five marketing channels that events are dealt over.
CHANNELS = [f"channel_{k}" for k in range(5)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as a TIMESTAMP instant (ntz read as UTC), ``seq`` = event_id
    (arrival order) and ``k`` = the integer in ``props``."""
    df = read_table(spark, sf_dir, "events")
    df = to_event_time(df, "ts")
    return (df.withColumn("seq", F.col("event_id"))
              .withColumn("k", F.get_json_object("props", "$.k").cast("long")))


# ---- adapters: events -> reference record shapes -------------------------------------

# The adapters keep the event type as it is, so predicates on it reach the parquet
# scan; callers pass the driver-table value ('view', 'purchase', ...) where the
# reference's jobs compare with 'pv', 'create', 'pay'.
VIEW, PURCHASE, SIGNUP, CLICK, ERROR = "view", "purchase", "signup", "click", "error"


def as_user_behavior(ev: DataFrame) -> DataFrame:
    """UserBehavior: item = k, category = k div 10, behavior = event type ('view' = pv)."""
    return ev.select(
        "user_id", F.col("k").alias("item_id"), F.expr("k div 10").alias("category_id"),
        F.col("event_type").alias("behavior"),
        F.unix_seconds("ts").alias("ts_s"), "ts", "seq", "event_id")


def as_marketing(ev: DataFrame) -> DataFrame:
    """Marketing events: behavior = event_type, channel = CHANNELS[k mod 5]."""
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.pmod("k", F.lit(5)) + 1).cast("int"))
    return ev.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("event_type").alias("behavior"), channel.alias("channel"), "ts", "seq")


def as_ad_clicks(ev: DataFrame) -> DataFrame:
    """Ad clicks from click events: province = k mod 10 (as text), ad_id = k."""
    return (ev.filter(F.col("event_type") == "click")
              .select("user_id", F.col("k").alias("ad_id"),
                      F.pmod("k", F.lit(10)).cast("string").alias("province"),
                      F.lit("").alias("city"), "ts", "seq", "event_id"))


def as_logins(ev: DataFrame) -> DataFrame:
    """Logins: an ``error`` event is a failed login, everything else a success."""
    return ev.select("user_id", F.lit("").alias("ip"),
                     F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success"))
                     .alias("event_type"), "ts", "seq", "event_id")


def as_order_events(ev: DataFrame) -> DataFrame:
    """Order events keyed by user; status = event type ('view' = create, 'purchase' = pay)."""
    return ev.select(F.col("user_id").alias("order_id"), F.col("event_type").alias("pay_status"),
                     F.col("event_id").cast("string").alias("pay_id"), "ts", "seq", "event_id")


def as_pays(ev: DataFrame) -> DataFrame:
    """Payments for the receipt jobs: purchase events, keyed by user."""
    return (ev.filter(F.col("event_type") == "purchase")
              .select(F.col("user_id").alias("pay_id"), "ts", "seq", "event_id"))


def as_receipts(ev: DataFrame) -> DataFrame:
    """Receipts for the receipt jobs: signup events, keyed by user."""
    return (ev.filter(F.col("event_type") == "signup")
              .select(F.col("user_id").alias("pay_id"), "ts", "seq", "event_id"))


def as_access_log(ev: DataFrame) -> DataFrame:
    """Access-log rows: url = '/item/' || k for every event."""
    return ev.select(F.col("user_id").cast("string").alias("ip"), F.lit("GET").alias("method"),
                     F.concat(F.lit("/item/"), F.col("k").cast("string")).alias("url"), "ts", "seq")


def behavior_lines(ev: DataFrame) -> DataFrame:
    """The events as lines of the behaviour input (blanks around its fields)."""
    return ev.select(F.concat_ws(" , ", "user_id", "k", F.expr("k div 10"), "event_type", F.unix_seconds("ts")).alias("value"), "seq")


def marketing_lines(ev: DataFrame) -> DataFrame:
    """The events as lines of the marketing input."""
    return as_marketing(ev).select(F.concat_ws(",", "user_id", "behavior", "channel", F.unix_millis("ts")).alias("value"), "seq")


def access_log_lines(ev: DataFrame) -> DataFrame:
    """The events as access-log lines (UTC)."""
    log = as_access_log(ev)
    wall = F.date_format(F.timestamp_add("MICROSECOND", F.unix_micros("ts"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")),
                         "dd/MM/yyyy:HH:mm:ss")
    return log.select(F.concat_ws(" ", "ip", F.lit("-"), F.lit("-"), wall, F.lit("+0000"), "method", "url").alias("value"), "seq")
