"""Per-key click cap with a one-time warning.

Rows are numbered per key in event order (ts, seq).  Rows 1..cap are kept, row
cap+1 is the one that triggers the warning, later rows are dropped.  The filter
``row_number <= cap + 1`` sits directly on the window, so Catalyst inserts a
``WindowGroupLimit`` that cuts every key to cap+1 rows inside each map task,
before the shuffle: a key holding a third of all rows ships at most cap+1 rows
per task.  (The session raises ``spark.sql.optimizer.windowGroupLimitThreshold``
so this holds for caps up to that value.)

Null keys form one group, as in SQL ``PARTITION BY``.

``reset="never"`` is the reference replayed on old data: its reset timer is set
from processing time, so it never fires inside the input and the count runs
over the key's whole history.  ``reset="event_day"`` counts per (key, UTC day).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import floor_to, millis

# Fixed value: the reference's warning text.
BLACKLIST_MSG = "Input blacklist"


class CapResult(NamedTuple):
    kept: DataFrame       # rows within the cap (main output)
    warnings: DataFrame   # one row per capped key: keys, ts, seq of the first refused row, msg


def cap_per_key(df: DataFrame, keys, cap: int, ts: str = "ts", seq: str = "seq",
                reset: str = "never", msg: str = BLACKLIST_MSG) -> CapResult:
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = _ranked(df, keys, cap, ts, seq, reset)
    kept = ranked.filter(F.col("_r") <= cap).drop("_r")
    warnings = (ranked.filter(F.col("_r") == cap + 1)
                .select(*keys, ts, seq, F.lit(msg).alias("msg")))
    return CapResult(kept, warnings)


def _ranked(df, keys, cap, ts, seq, reset) -> DataFrame:
    part = [F.col(k) for k in keys]
    if reset == "event_day":
        part.append(floor_to(millis(ts), 86_400_000).alias("_day"))
    elif reset != "never":
        raise ValueError("reset must be 'never' or 'event_day'")
    w = Window.partitionBy(*part).orderBy(F.col(ts), F.col(seq))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap + 1)


def cap_outcome(df: DataFrame, keys, cap: int, ts: str = "ts", seq: str = "seq", reset: str = "never",
                msg: str = BLACKLIST_MSG) -> DataFrame:
    """``cap_per_key`` as one frame (S10): the rows with ``branch`` ('kept' or 'warnings') and msg."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    refused = F.col("_r") > cap
    return _ranked(df, keys, cap, ts, seq, reset).select(
        *df.columns, F.when(refused, F.lit("warnings")).otherwise(F.lit("kept")).alias("branch"),
        F.when(refused, F.lit(msg)).alias("msg"))
