"""Positional schemas of the reference's text inputs (no header, comma separated).

Event times arrive as epoch seconds (or ms for marketing events); readers add a
``ts`` TIMESTAMP column and a ``seq`` arrival number.
"""

from pyspark.sql import types as T

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

ORDER_PAY = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("pay_status", T.StringType()),
    T.StructField("pay_id", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

RECEIPT = T.StructType([
    T.StructField("pay_id", T.StringType()),
    T.StructField("pay_type", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

MARKETING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

# access log: space separated; fields 0 ip, 3 time (dd/MM/yyyy:HH:mm:ss), 5 method, 6 url
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
