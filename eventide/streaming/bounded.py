"""The end of a bounded stream.

An input that ends moves no watermark any more, so its last windows, the rows behind the last
watermark and open rows without a time limit stay in the operators' state.  The functions here
read that state with Spark's state sources (``state-metadata``, ``statestore``) after the query has
stopped, and finish it by the batch rule: what the state holds are the rows, numbers and partial
aggregates from which the batch operators go on.  Nothing is written to the checkpoint, so a
query can be drained, given more input and drained again.

Each ``drain_*`` takes the checkpoint and the arguments of its ``stream_*`` function and returns
what the batch operator returns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import interval_millis
from eventide.operators.aggs import finish_exprs, merge_exprs
from eventide.operators.joins import PairResult, pair_one_to_one
from eventide.operators.limits import BLACKLIST_MSG, CapResult
from eventide.operators.patterns import PatternResult, followed_by, strict_pairs
from eventide.streaming.payload import payload_fields, unpack

AGGREGATE = "stateStoreSave"


def operators(spark: SparkSession, checkpoint: str) -> list[tuple[int, str, set[str]]]:
    """(id, name, state variables) of the query's stateful operators (a few rows)."""
    found = spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "operatorProperties").distinct().collect()
    return [(r.operatorId, r.operatorName,
             {v["stateName"] for v in json.loads(r.operatorProperties or "{}").get("stateVariables", [])})
            for r in found]


def next_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number that the query's next micro-batch will have."""
    last = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    return 0 if last is None else last + 1


def read_state(spark: SparkSession, checkpoint: str, variable: str | None = None, operator: str | None = None) -> list[DataFrame]:
    """The state of each operator with this variable (``transformWithState``) or of this name."""
    out = []
    for number, name, variables in operators(spark, checkpoint):
        if (variable in variables) if variable else name == operator:
            r = spark.read.format("statestore").option("operatorId", number)
            out.append((r.option("stateVarName", variable) if variable else r).load(checkpoint))
    return out


def _only(frames: list[DataFrame]) -> DataFrame:
    if len(frames) != 1:
        raise ValueError(f"{len(frames)} operators hold such state, one was expected")
    return frames[0]


def held_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that a replay operator holds: its keys, us, seq, side, p, q, home, a, b."""
    waiting = _only(read_state(spark, checkpoint, "buf")).select("key.*", "list_element.*")
    kept = _only(read_state(spark, checkpoint, "st")).select("key.*", F.explode("value.items").alias("_i"))
    keys = [c for c in kept.columns if c != "_i"]
    return kept.select(*keys, "_i.*").unionByName(waiting)


def drain_cap_per_key(spark, checkpoint, df, keys, cap: int, ts: str = "ts", seq: str = "seq",
                      reset: str = "never", msg: str = BLACKLIST_MSG) -> CapResult:
    """The waiting rows, numbered on from their key's number."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    part = [*keys, "_day"] if reset == "event_day" else keys
    fields = payload_fields(df.schema, keys)
    numbers = _only(read_state(spark, checkpoint, "st")).select(
        *[F.col(f"key.{k}").alias(f"_k{i}") for i, k in enumerate(part)], F.col("value.n").alias("_n"))
    rows = _only(read_state(spark, checkpoint, "buf")).select("key.*", *unpack("list_element.a", fields))
    on = F.lit(True)
    for i, k in enumerate(part):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    place = F.row_number().over(Window.partitionBy(*part).orderBy(ts, seq))
    ranked = (rows.withColumn("_place", place).filter(F.col("_place") <= cap + 1).join(numbers, on, "left")
              .withColumn("_r", F.col("_place") + F.coalesce("_n", F.lit(0))))
    kept = ranked.filter(F.col("_r") <= cap).select(*df.columns)
    warnings = ranked.filter(F.col("_r") == cap + 1).select(*keys, ts, seq, F.lit(msg).alias("msg"))
    return CapResult(kept, warnings)


def drain_strict_pairs(spark, checkpoint, df, within, keys=(), ts: str = "ts", seq: str = "seq", carry=()) -> DataFrame:
    """X1 over each key's previous row and the rows that wait."""
    keys, carry = [keys] if isinstance(keys, str) else list(keys or []), list(carry)
    fields = [f for f in payload_fields(df.schema, keys) if f.name in (ts, seq, *carry)]
    rows = held_rows(spark, checkpoint)
    groups = keys or ["_bucket"]
    rows = rows.select(*groups, *unpack("a", fields), (F.col("p") & F.col("home")).alias("_begin"), F.col("q").alias("_next"))
    found = strict_pairs(rows, F.col("_begin"), F.col("_next"), within, groups, ts, seq, carry)
    return found if keys else found.drop("_bucket")


def drain_followed_by(spark, checkpoint, df, within, keys, ts: str = "ts", seq: str = "seq", carry=()) -> PatternResult:
    """X2/X3 over the open begin rows and the rows that wait; what stays open has timed out."""
    keys, carry = [keys] if isinstance(keys, str) else list(keys), list(carry)
    fields = [f for f in payload_fields(df.schema, keys) if f.name in (ts, seq, *carry)]
    rows = held_rows(spark, checkpoint).select(*keys, *unpack("a", fields), F.col("p").alias("_begin"), F.col("q").alias("_follow"))
    return followed_by(rows, F.col("_begin"), F.col("_follow"), within, keys, ts, seq, carry)


def drain_pair_one_to_one(spark, checkpoint, left, right, on, timeout=None, ts: str = "ts", seq: str = "seq",
                          left_prefix: str = "left_", right_prefix: str = "right_") -> PairResult:
    """J2-J4 over the pending rows and the rows that wait; what stays pending has no partner."""
    keys = [on] if isinstance(on, str) else list(on)
    rows = held_rows(spark, checkpoint)
    sides = [rows.filter(F.col("side") == i).select(*keys, *unpack(s, payload_fields(df.schema, keys)))
             for i, (s, df) in enumerate((("a", left), ("b", right)))]
    return pair_one_to_one(*sides, keys, ts, seq, timeout, left_prefix, right_prefix)


def drain_first_sightings(spark, checkpoint) -> DataFrame:
    """The rows that wait, flagged against the values their window has seen."""
    rows = _only(read_state(spark, checkpoint, "buf")).select("key.*", "list_element.*")
    seen = _only(read_state(spark, checkpoint, "seen")).select(
        F.col("key.window_end").alias("_w"), F.col("user_map_key.v").alias("_v"))
    first = F.row_number().over(Window.partitionBy("window_end", "part", "v").orderBy("us", "seq")) == 1
    rows = rows.withColumn("_first", first).join(
        seen, (F.col("window_end") == F.col("_w")) & F.col("v").eqNullSafe(F.col("_v")), "left")
    flag = (F.col("_first") & F.col("_w").isNull()).cast("long").alias("first")
    return rows.select("window_end", "part", "us", "seq", flag)


def _window_state(state: DataFrame, keys, partials) -> DataFrame:
    """Window bounds, keys and partial aggregates (name, expression) of an aggregate's state."""
    key, value = state.schema["key"].dataType, state.schema["value"].dataType
    # by position: the state names its columns after the functions, and holds equal ones once
    places = list(range(len(partials)))
    if len(value) < len(partials):
        distinct = list(dict.fromkeys(str(c) for _, c in partials))
        places = [distinct.index(str(c)) for _, c in partials]
    named = T.StructType([T.StructField(f"v{i}", f.dataType) for i, f in enumerate(value.fields)])
    rows = state.select("key", F.col("value").cast(named).alias("value"))
    return rows.select(F.unix_millis(f"key.{key[0].name}.start").alias("_start"),
                       F.unix_millis(f"key.{key[0].name}.end").alias("_end"), *[F.col(f"key.{k}") for k in keys],
                       *[F.col(f"value.v{i}").alias(n) for i, (n, _) in zip(places, partials)])


def drain_windows(spark, checkpoint, size, aggs, keys=(), slide=None, with_start: bool = False) -> DataFrame:
    """Windows that are still open: keys, [window_start], window_end, aggregates.

    Sliding windows are kept as panes and as windows merged from panes so far: both are merged.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_ms = interval_millis(size)
    slide_ms = interval_millis(slide) if slide else size_ms
    partials = [p for a in aggs for p in a.partials()]
    parts = []
    for state in read_state(spark, checkpoint, operator=AGGREGATE):
        # (the state of one operator has windows of one length; the other filter finds nothing)
        rows = _window_state(state, keys, partials)
        wide = F.col("_end") - F.col("_start")
        parts.append(rows.filter(wide == size_ms))
        if slide_ms != size_ms:
            ends = F.sequence(F.col("_end"), F.col("_start") + F.lit(size_ms), F.lit(slide_ms))
            panes = rows.filter(wide == slide_ms).withColumn("_end", F.explode(ends))
            parts.append(panes.withColumn("_start", F.col("_end") - F.lit(size_ms)))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    merged = whole.groupBy(*keys, "_start", "_end").agg(*merge_exprs(aggs))
    start = [F.col("_start").alias("window_start")] if with_start else []
    return merged.select(*keys, *start, F.col("_end").alias("window_end"), *finish_exprs(aggs))


def drain_distinct(spark, checkpoint, out: str = "uv") -> DataFrame:
    """A5: open windows of ``stream_distinct_per_window`` (its deduplication lets first rows through at once)."""
    state = _only(read_state(spark, checkpoint, operator=AGGREGATE))
    return _window_state(state, [], [(out, F.count(F.lit(1)))]).select(F.col("_end").alias("window_end"), out)


def drain_capped_counts(spark, checkpoint, df, keys, cap: int, by: str, size, ts: str = "ts", seq: str = "seq",
                        reset: str = "never") -> tuple[DataFrame, DataFrame]:
    """Q7: (counts per ``by`` and open window, warnings) of the chained cap and window counts."""
    size_ms = interval_millis(size)
    capped = drain_cap_per_key(spark, checkpoint, df, keys, cap, ts, seq, reset)
    t = F.unix_millis(ts)
    kept = capped.kept.select(by, (t - F.pmod(t, F.lit(size_ms)) + F.lit(size_ms)).alias("window_end"), F.lit(1).alias("n"))
    counted = _only(read_state(spark, checkpoint, "counts")).select(
        F.col(f"key.{by}").alias(by), F.col("user_map_key.window_end"), F.col("user_map_value.n"))
    counts = kept.unionByName(counted).groupBy(by, "window_end").agg(F.sum("n").cast("long").alias("cnt"))
    return counts, capped.warnings
