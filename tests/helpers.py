"""Small builders for hand-written test rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.time import to_event_time

T0 = 1_600_000_000  # an arbitrary epoch second, not from any shipped file


def frame(spark, schema: str, data):
    """DataFrame from tuples; a ``ts_s`` column (epoch seconds) becomes ``ts``."""
    df = spark.createDataFrame(data, schema)
    if "ts_s" in df.columns:
        df = to_event_time(df, "ts_s", "s")
    if "seq" not in df.columns:
        df = df.withColumn("seq", F.monotonically_increasing_id())
    return df
