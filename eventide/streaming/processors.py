"""Keyed stateful stream operators with ``transformWithState``.

Spark hash-partitions the stream by key; per key a ``StatefulProcessor`` keeps the rows that the
watermark has not passed yet (rows of one micro-batch arrive in any order) and replays the others
in (ts, seq) order through a tiny state machine kept in value state.  Rows are kept whole: the
state schema holds a payload struct derived from the input's schema (``streaming.payload``), so the
outputs carry the same columns as the batch operators'.  A mark (least buffered time, next time
the machine can act) saves reading the buffer while nothing is due; one event-time timer makes
progress without new input for the key; state is written only when it changed and cleared when
empty.  The per-row work is a few comparisons; everything else (partitioning, state store,
checkpoints, recovery after executor loss) is Spark's.

A buffered row is ``(us, seq, side, p, q, home, a, b)``: ``side`` tells the two inputs of the pairing
apart, ``p`` / ``q`` are the pattern predicates evaluated by Spark before the shuffle, ``home`` marks
rows in their own time bucket (H2), ``a`` / ``b`` hold the payload of the left / right input.

What a bounded input leaves in the state (rows after the last watermark, open rows without a time
limit) is drained by the batch rule: ``streaming.bounded``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.time import interval_micros, interval_millis
from eventide.operators.limits import BLACKLIST_MSG
from eventide.streaming.payload import pack, payload_fields, stored_type, unpack

US, SEQ, SIDE, P, Q, HOME, A, B = range(8)
DAY_MS = 86_400_000


def row_schema(left: T.StructType, right: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("us", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("side", T.IntegerType()),
        T.StructField("p", T.BooleanType()), T.StructField("q", T.BooleanType()),
        T.StructField("home", T.BooleanType()), T.StructField("a", left), T.StructField("b", right)])


def state_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("n", T.LongType()),                   # number of the key's last row (cap)
        T.StructField("until", T.LongType()),               # when the number is forgotten (ms)
        T.StructField("items", T.ArrayType(row))])          # previous / open / pending rows


MARK_SCHEMA = T.StructType([T.StructField("due", T.LongType()), T.StructField("alarm", T.LongType())])


def _plain(value):
    """Rows of the state as plain tuples (the state API does not take Rows back)."""
    if isinstance(value, tuple):
        return tuple(_plain(v) for v in value)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return value


def _payload(value, names):
    """An incoming payload struct (a dict or a Row) as a tuple."""
    return None if value is None else tuple(value[n] for n in names)


class _Machine:
    """Per-key state machine over rows in (ts, seq, side) order; emits (kind, left row, right row)."""

    def step(self, st: dict, r) -> list[tuple]:
        raise NotImplementedError

    def on_watermark(self, st: dict, wm: int) -> list[tuple]:
        return []

    def timers(self, st: dict) -> list[int]:
        return []


class CapMachine(_Machine):
    """E13 by the batch rule: a key's rows are numbered, and the number alone decides.

    Numbers from cap + 2 on are all alike, so the numbering stops there.  With ``daily`` the key
    includes the day, and its number is forgotten when the day is over; with ``idle_ms`` it is
    forgotten so long after the key's last row.
    """

    def __init__(self, cap: int, daily: bool = False, idle_ms: int | None = None):
        self.cap, self.daily, self.idle = cap, daily, idle_ms

    def step(self, st, r):
        number = st["n"] = min(st["n"] + 1, self.cap + 2)
        ms = r[US] // 1000
        if self.daily:
            st["until"] = ms - ms % DAY_MS + DAY_MS
        elif self.idle is not None:
            st["until"] = ms + self.idle
        kind = "kept" if number <= self.cap else "warning" if number == self.cap + 1 else None
        return [(kind, r[A], None)] if kind else []

    def on_watermark(self, st, wm):
        if st["until"] is not None and st["until"] <= wm:
            st["n"], st["until"] = 0, None
        return []

    def timers(self, st):
        return [st["until"]] if st["until"] is not None else []


class StrictPairMachine(_Machine):
    """The previous row satisfies p, this one q, less than ``within`` apart."""

    def __init__(self, within_us: int | None):
        self.within = within_us

    def step(self, st, r):
        out = []
        prev = st["items"][0] if st["items"] else None
        if (prev is not None and prev[P] and prev[HOME] and r[Q]
                and (self.within is None or r[US] - prev[US] < self.within)):
            out.append(("pair", prev[A], r[A]))
        st["items"] = [r]
        return out


class FollowedByMachine(_Machine):
    """Open begin rows wait for the first later follow row."""

    def __init__(self, within_us: int | None):
        self.within = within_us

    def step(self, st, r):
        out = []
        if r[Q]:
            for b in st["items"]:
                if self.within is None or r[US] - b[US] < self.within:
                    out.append(("matched", b[A], r[A]))
                else:
                    out.append(("timeout", b[A], None))
            st["items"] = []
        if r[P] and r[HOME]:
            st["items"] = st["items"] + [r]
        return out

    def _horizon(self, b):
        # in ms, rounded up: all follow rows that are in time come before it
        return -(-(b[US] + self.within) // 1000)

    def on_watermark(self, st, wm):
        if self.within is None:
            return []
        out = [("timeout", b[A], None) for b in st["items"] if self._horizon(b) <= wm]
        st["items"] = [b for b in st["items"] if self._horizon(b) > wm]
        return out

    def timers(self, st):
        return [] if self.within is None else [self._horizon(b) for b in st["items"]]


class PairMachine(_Machine):
    """One pending slot; the other side closes it, the same side overwrites it."""

    def __init__(self, timeout_us: int | None):
        self.timeout = timeout_us

    @staticmethod
    def _expire(pend):
        return ("left_only" if pend[SIDE] == 0 else "right_only", pend[A], pend[B])

    def step(self, st, r):
        out = []
        pend = st["items"][0] if st["items"] else None
        if pend is not None and self.timeout is not None and r[US] - pend[US] > self.timeout:
            out.append(self._expire(pend))
            pend = None
        if pend is None:
            st["items"] = [r]
        elif pend[SIDE] != r[SIDE]:
            left, right = (pend, r) if pend[SIDE] == 0 else (r, pend)
            out.append(("matched", left[A], right[B]))
            st["items"] = []
        else:
            out.append(("overwritten", pend[A], pend[B]))
            st["items"] = [r]
        return out

    def _horizon(self, pend):
        return (pend[US] + self.timeout) // 1000 + 1

    def on_watermark(self, st, wm):
        if self.timeout is not None and st["items"] and self._horizon(st["items"][0]) <= wm:
            pend, st["items"] = st["items"][0], []
            return [self._expire(pend)]
        return []

    def timers(self, st):
        return [self._horizon(st["items"][0])] if self.timeout is not None and st["items"] else []


class OrderedReplay(StatefulProcessor):
    """Buffers a key's rows until the watermark passes them, then feeds them in
    (ts, seq, side) order to a ``_Machine``.

    ``hand_on``: outputs carry ``emit_ts``, the watermark at which they left, as event time of a
    next stateful operator (their own times are behind the watermark by then).
    """

    def __init__(self, machine: _Machine, keys: list[str], left: T.StructType, right: T.StructType, hand_on: bool):
        self.machine, self.keys, self.hand_on = machine, list(keys), hand_on
        self.left, self.right = left.names, right.names
        self.row = row_schema(left, right)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", self.row)
        self.state = handle.getValueState("st", state_schema(self.row))
        self.mark = handle.getValueState("mark", MARK_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["us"], r["seq"], r["side"], r["p"], r["q"], r["home"], _payload(r["a"], self.left),
                _payload(r["b"], self.right)) for r in rows]
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, new, wm: int) -> Iterator[Row]:
        held = _plain(tuple(self.mark.get())) if self.mark.exists() else (None, None)
        due, alarm = held
        if new:
            due = min([r[US] for r in new] + ([due] if due is not None else []))
        out = []
        if (due is not None and due < wm * 1000) or (alarm is not None and alarm <= wm):
            due, alarm, out = self._replay(new, wm, due)
        elif new:
            self.buf.appendList(new)
        if (due, alarm) != held:
            if due is None and alarm is None:
                self.mark.clear()
            else:
                self.mark.update((due, alarm))
                self.handle.registerTimer(min(t for t in (alarm, due // 1000 + 1 if due is not None else None)
                                              if t is not None))
        keys = tuple(key) if isinstance(key, (tuple, list)) else (key,)
        at = {"emit_ts": datetime.fromtimestamp(wm / 1000, timezone.utc)} if self.hand_on else {}
        for kind, a, b in out:
            yield Row(**dict(zip(self.keys, keys)), kind=kind, a=a, b=b, **at)

    def _replay(self, new, wm: int, due):
        """Feed the rows behind the watermark to the machine; returns the new mark and the outputs."""
        stored = []
        if due is not None and due < wm * 1000:
            stored = [_plain(tuple(r)) for r in self.buf.get()] if self.buf.exists() else []
            rows = stored + new
            ready = sorted((r for r in rows if r[US] < wm * 1000), key=lambda r: (r[US], r[SEQ], r[SIDE]))
            rest = [r for r in rows if r[US] >= wm * 1000]
            if rest:
                self.buf.put(rest)
            elif stored:
                self.buf.clear()
            due = min((r[US] for r in rest), default=None)
        else:
            ready = []
            if new:
                self.buf.appendList(new)
        before = (0, None, [])
        if self.state.exists():
            n, until, items = self.state.get()
            before = (n, until, [_plain(tuple(i)) for i in items or []])
        st = {"n": before[0], "until": before[1], "items": list(before[2])}
        out = []
        for r in ready:
            out += self.machine.step(st, r)
        out += self.machine.on_watermark(st, wm)
        after = (st["n"], st["until"], st["items"])
        if after != before:
            if after == (0, None, []):
                self.state.clear()
            else:
                self.state.update(after)
        return due, min(self.machine.timers(st), default=None), out

    def close(self) -> None:
        pass


def _staged(df: DataFrame, keys, ts: str, seq: str, side: Column, p: Column, q: Column, home: Column,
            a: Column, b: Column) -> DataFrame:
    def given(c):
        return F.coalesce(c, F.lit(False))
    # rows without time or order cannot be placed
    placed = df.filter(F.col(ts).isNotNull() & F.col(seq).isNotNull())
    return placed.select(*keys, F.col(ts).alias("_ts"), F.unix_micros(ts).alias("us"), F.col(seq).cast("long").alias("seq"),
                     side.cast("int").alias("side"), given(p).alias("p"), given(q).alias("q"),
                     given(home).alias("home"), a.alias("a"), b.alias("b"))


def _run(staged: DataFrame, keys: list[str], machine: _Machine, delay, left, right, hand_on: bool = False) -> DataFrame:
    """keys, kind, a, b (payload structs) of the machine's outputs."""
    left, right = stored_type(left), stored_type(right)
    fields = [T.StructField(k, staged.schema[k].dataType) for k in keys]
    fields += [T.StructField("kind", T.StringType()), T.StructField("a", left), T.StructField("b", right)]
    if hand_on:
        fields.append(T.StructField("emit_ts", T.TimestampType()))
    return staged.withWatermark("_ts", str(delay)).groupBy(*keys).transformWithState(
        OrderedReplay(machine, keys, left, right, hand_on), T.StructType(fields), "append", "EventTime",
        eventTimeColumnName="emit_ts" if hand_on else "")


def _single(df: DataFrame, keys, machine, ts, seq, delay, p=None, q=None, home=None, hand_on=False):
    """Run a machine over one input; both payloads have the input's fields."""
    true = F.lit(True)
    fields = payload_fields(df.schema, keys)
    staged = _staged(df, keys, ts, seq, F.lit(0), true if p is None else p, true if q is None else q,
                     true if home is None else home, pack(fields), F.lit(None).cast(stored_type(fields)))
    return _run(staged, keys, machine, delay, fields, fields, hand_on), fields


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _with_keys(df: DataFrame, keys) -> DataFrame:
    """The sequence operators ignore rows without a key, as their batch forms."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def day_of(ts: str) -> Column:
    ms = F.unix_millis(ts)
    return ms - F.pmod(ms, F.lit(DAY_MS))


def stream_cap_per_key(df: DataFrame, keys, cap: int, ts: str = "ts", seq: str = "seq", delay="0 seconds",
                       reset: str = "never", idle=None, msg: str = BLACKLIST_MSG, hand_on: bool = False) -> DataFrame:
    """E13 on a stream -> the input's columns, kind ('kept' | 'warning'), msg of warnings.

    ``reset="event_day"`` counts per (key, UTC day) as the batch operator; a day's state is dropped
    when the watermark passes its end.  With ``reset="never"`` a key's number stays for good,
    unless ``idle`` says after how long without rows it may be forgotten.
    """
    keys = _keys(keys)
    if reset not in ("never", "event_day"):
        raise ValueError("reset must be 'never' or 'event_day'")
    daily = reset == "event_day"
    work, gkeys = (df.withColumn("_day", day_of(ts)), [*keys, "_day"]) if daily else (df, keys)
    machine = CapMachine(cap, daily, interval_millis(idle) if idle is not None else None)
    out, fields = _single(work, gkeys, machine, ts, seq, delay, hand_on=hand_on)
    handed = ["emit_ts"] if hand_on else []
    return out.select(*keys, *unpack("a", fields), "kind",
                      F.when(F.col("kind") == "warning", F.lit(msg)).alias("msg"), *handed)


def unkeyed_buckets(df: DataFrame, ts: str, within_us: int) -> DataFrame:
    """Add ``_bucket`` and ``_home``: rows near a bucket's start are copied to the one before (H2)."""
    b = 4 * within_us
    t = F.unix_micros(ts)
    here = t - F.pmod(t, F.lit(b))
    back = (t - F.lit(within_us)) - F.pmod(t - F.lit(within_us), F.lit(b))
    one = F.struct(here.alias("b"), F.lit(True).alias("h"))
    copies = F.when(here != back, F.array(one, F.struct(back.alias("b"), F.lit(False).alias("h")))).otherwise(F.array(one))
    return df.withColumn("_copy", F.explode(copies)).select(
        *df.columns, F.col("_copy.b").alias("_bucket"), F.col("_copy.h").alias("_home"))


def stream_strict_pairs(df: DataFrame, begin: Column, nxt: Column, within, keys=(), ts: str = "ts",
                        seq: str = "seq", delay="0 seconds", carry=()) -> DataFrame:
    """X1 on a stream, with the batch operator's columns: keys, first_ts, first_seq, second_ts,
    second_seq and first_<c> / second_<c> for the columns in ``carry``.

    Without keys the rows are keyed by time buckets (H2) so the pattern is not one task."""
    keys, carry = _keys(keys), list(carry)
    w_us = interval_micros(within) if within is not None else None
    picked = _with_keys(df, keys).select(*keys, ts, seq, *carry, begin.alias("_p"), nxt.alias("_q"))
    home, gkeys = F.lit(True), keys
    if not keys:
        if w_us is None:
            raise ValueError("an unkeyed stream pattern needs a time limit")
        picked, home, gkeys = unkeyed_buckets(picked, ts, w_us), F.col("_home"), ["_bucket"]
    fields = [f for f in payload_fields(picked.schema, gkeys) if f.name in (ts, seq, *carry)]
    staged = _staged(picked, gkeys, ts, seq, F.lit(0), F.col("_p"), F.col("_q"), home, pack(fields),
                     F.lit(None).cast(stored_type(fields)))
    out = _run(staged, gkeys, StrictPairMachine(w_us), delay, fields, fields)
    named = [c for side, s in (("first_", "a"), ("second_", "b")) for c in unpack(s, fields, side)]
    order = [f"{side}_{c}" for side in ("first", "second") for c in (ts, seq)]
    order += [f"{side}_{c}" for side in ("first", "second") for c in carry]
    return out.select(*keys, *named).select(*keys, *order)


def stream_followed_by(df: DataFrame, begin: Column, follow: Column, within, keys, ts: str = "ts",
                       seq: str = "seq", delay="0 seconds", carry=()) -> DataFrame:
    """X2/X3 on a stream -> keys, kind ('matched' | 'timeout'), begin_ts, begin_seq, follow_ts,
    follow_seq (null for timeouts) and begin_<c> / follow_<c> for the columns in ``carry``.

    A begin row is decided once the watermark passes ``begin.ts + within`` (or when its follow row
    is replayed); without a time limit open rows stay until the input ends (``streaming.bounded``)."""
    keys, carry = _keys(keys), list(carry)
    w_us = interval_micros(within) if within is not None else None
    picked = _with_keys(df, keys).select(*keys, ts, seq, *carry, begin.alias("_p"), follow.alias("_q")).filter("_p OR _q")
    fields = [f for f in payload_fields(picked.schema, keys) if f.name in (ts, seq, *carry)]
    staged = _staged(picked, keys, ts, seq, F.lit(0), F.col("_p"), F.col("_q"), F.lit(True), pack(fields),
                     F.lit(None).cast(stored_type(fields)))
    out = _run(staged, keys, FollowedByMachine(w_us), delay, fields, fields)
    return out.select(*keys, "kind", *unpack("a", fields, "begin_"), *unpack("b", fields, "follow_"))


def stream_pair_one_to_one(left: DataFrame, right: DataFrame, on, timeout=None, ts: str = "ts", seq: str = "seq",
                           delay="0 seconds", left_prefix: str = "left_", right_prefix: str = "right_") -> DataFrame:
    """J2-J4 on streams -> keys, kind ('matched' | 'left_only' | 'right_only' | 'overwritten') and
    all columns of both rows, prefixed as by the batch operator (null where a row has no partner).

    Without a timeout, pending rows stay until the input ends (``streaming.bounded``)."""
    keys = _keys(on)
    lf, rf = payload_fields(left.schema, keys), payload_fields(right.schema, keys)

    def side(df, number, a, b):
        true = F.lit(True)
        return _staged(df, keys, ts, seq, F.lit(number), true, true, true, a, b)
    left, right = _with_keys(left, keys), _with_keys(right, keys)
    both = side(left, 0, pack(lf), F.lit(None).cast(stored_type(rf))).unionByName(
        side(right, 1, F.lit(None).cast(stored_type(lf)), pack(rf)))
    machine = PairMachine(interval_micros(timeout) if timeout is not None else None)
    out = _run(both, keys, machine, delay, lf, rf)
    return out.select(*keys, "kind", *unpack("a", lf, left_prefix), *unpack("b", rf, right_prefix))


class WindowCounts(StatefulProcessor):
    """Counts per window of rows that bring their window along (a column), for rows that another
    stateful operator held until the watermark passed them.  A window leaves when the watermark
    passes its end; rows of other kinds pass through."""

    def __init__(self, keys: list[str], passed: T.StructType):
        self.keys, self.passed = keys, passed.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "window_end long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = {}
        for r in rows:
            if r["window_end"] is None:
                yield self._row(key, None, None, _payload(r["passed"], self.passed))
            else:
                new[r["window_end"]] = new.get(r["window_end"], 0) + 1
        for end, n in new.items():
            if self.counts.containsKey((end,)):
                n += self.counts.getValue((end,))[0]
            self.counts.updateValue((end,), (n,))
            self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        for end, n in [(k[0], v[0]) for k, v in self.counts.iterator() if k[0] <= wm]:
            self.counts.removeKey((end,))
            yield self._row(key, end, n, None)

    def _row(self, key, end, n, passed):
        keys = tuple(key) if isinstance(key, (tuple, list)) else (key,)
        return Row(**dict(zip(self.keys, keys)), window_end=end, cnt=n, passed=passed)

    def close(self) -> None:
        pass


def stream_capped_counts(df: DataFrame, keys, cap: int, by: str, size, ts: str = "ts", seq: str = "seq",
                         delay="0 seconds", reset: str = "never", salts: int = 8) -> DataFrame:
    """Q7 as one stream: a cap per key, then the kept rows counted per (``by``, tumbling window).

    Gives rows of counts (``by``, window_end, cnt; passed is null) and the cap's warnings (in
    ``passed``: the input's columns).  The second operator runs on the watermark that the first
    hands on.  A value of ``by`` is spread over ``salts`` keys; all of them emit a window in the
    same micro-batch, so its rows are summed there (``plans.stream_jobs``).
    """
    keys = _keys(keys)
    size_ms = interval_millis(size)
    fields = payload_fields(df.schema, ())
    capped = stream_cap_per_key(df, keys, cap, ts, seq, delay, reset, hand_on=True)
    t = F.unix_millis(ts)
    end = F.when(F.col("kind") == "kept", t - F.pmod(t, F.lit(size_ms)) + F.lit(size_ms))
    staged = capped.select(by, F.pmod(F.xxhash64(*keys), F.lit(salts)).alias("_salt"), "emit_ts", end.alias("window_end"),
                           F.when(F.col("kind") == "warning", pack(fields)).alias("passed"))
    passed = stored_type(fields)
    out = T.StructType([df.schema[by], T.StructField("_salt", T.LongType()), T.StructField("window_end", T.LongType()),
                        T.StructField("cnt", T.LongType()), T.StructField("passed", passed)])
    counted = staged.groupBy(by, "_salt").transformWithState(WindowCounts([by, "_salt"], passed), out, "append", "EventTime")
    return counted.select(by, "_salt", "window_end", "cnt", "passed")


class FirstSightings(StatefulProcessor):
    """A8/E8 on a stream: flags each event that brings a value its window has not seen.

    Keyed by (window end, part of the values), so one window is many tasks and a value is always
    judged in the same one.  Rows wait in list state until the watermark passes them and are then
    judged in (ts, seq) order against a map state of the values seen (the reference's bitmap).
    """

    ROW = T.StructType([T.StructField("us", T.LongType()), T.StructField("seq", T.LongType()),
                        T.StructField("v", T.LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", self.ROW)
        self.seen = handle.getMapState("seen", "v long", "x boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["us"], r["seq"], r["v"]) for r in rows]
        if new:
            self.buf.appendList(new)
        yield from self._drain(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._drain(key, timerValues.getCurrentWatermarkInMs())

    def _drain(self, key, wm: int) -> Iterator[Row]:
        window_end, part = key[0], key[1]
        rows = [_plain(tuple(r)) for r in self.buf.get()] if self.buf.exists() else []
        ready = sorted((r for r in rows if r[0] < wm * 1000), key=lambda r: (r[0], r[1]))
        rest = [r for r in rows if r[0] >= wm * 1000]
        if ready:
            if rest:
                self.buf.put(rest)
            else:
                self.buf.clear()
        for us, seq, v in ready:
            first = not self.seen.containsKey((v,))
            if first:
                self.seen.updateValue((v,), (True,))
            yield Row(window_end=window_end, part=part, us=us, seq=seq, first=int(first))
        if rest:
            self.handle.registerTimer(min(r[0] for r in rest) // 1000 + 1)
        elif window_end > wm:
            self.handle.registerTimer(window_end)
        else:
            self.seen.clear()       # the window is closed and drained

    def close(self) -> None:
        pass


def stream_first_sightings(df: DataFrame, col: str, size, ts: str = "ts", seq: str = "seq", delay="0 seconds",
                           hashed: bool = True, parts: int = 16) -> DataFrame:
    """Per event: window_end, part, us, seq, first (1 if its value is new in its tumbling window).

    ``hashed=True`` judges the reference's bitmap offsets, else exact (integral) values.  The
    running count per event follows per micro-batch: ``streaming.stores.running_counts``.
    """
    from eventide.functions.hashing import poly_hash
    size_ms = interval_millis(size)
    t = F.unix_millis(ts)
    integral = isinstance(df.schema[col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    v = poly_hash(col, integral=integral) if hashed else F.col(col).cast("long")
    staged = (df.filter(F.col(ts).isNotNull() & F.col(seq).isNotNull()).withWatermark(ts, str(delay))
                .select(ts, (t - F.pmod(t, F.lit(size_ms)) + F.lit(size_ms)).alias("window_end"),
                        F.unix_micros(ts).alias("us"), F.col(seq).cast("long").alias("seq"), v.alias("v")))
    staged = staged.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)))
    return staged.groupBy("window_end", "part").transformWithState(
        FirstSightings(), "window_end long, part long, us long, seq long, first long", "append", "EventTime")
