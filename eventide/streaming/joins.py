"""Stream-stream interval join (J1 on streams).

Both inputs carry watermarks; the time-range condition lets Spark evict buffered
rows of each side once the other side's watermark makes a match impossible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.joins import _signed_us


def stream_interval_join(left: DataFrame, right: DataFrame, on, lower, upper, left_ts: str = "ts",
                         right_ts: str = "ts", left_prefix: str = "left_", right_prefix: str = "right_",
                         left_delay="0 seconds", right_delay="0 seconds") -> DataFrame:
    """Inner interval join of two streams:
    ``left.ts + lower <= right.ts <= left.ts + upper`` on equal keys."""
    keys = [on] if isinstance(on, str) else list(on)
    lo, hi = _signed_us(lower), _signed_us(upper)
    l = left.select(*[F.col(k).alias(f"_lk_{k}") for k in keys],
                    *[F.col(c).alias(left_prefix + c) for c in left.columns if c not in keys])
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                     *[F.col(c).alias(right_prefix + c) for c in right.columns if c not in keys])
    lt, rt = left_prefix + left_ts, right_prefix + right_ts
    l = l.withWatermark(lt, str(left_delay))
    r = r.withWatermark(rt, str(right_delay))
    cond = [F.col(f"_lk_{k}") == F.col(f"_rk_{k}") for k in keys]
    cond.append(F.col(rt) >= F.col(lt) + F.expr(f"INTERVAL '{lo}' MICROSECOND"))
    cond.append(F.col(rt) <= F.col(lt) + F.expr(f"INTERVAL '{hi}' MICROSECOND"))
    out = l.join(r, cond, "inner")
    return out.select(*[F.col(f"_lk_{k}").alias(k) for k in keys],
                      *[c for c in l.columns if not c.startswith("_lk_")],
                      *[c for c in r.columns if not c.startswith("_rk_")])
