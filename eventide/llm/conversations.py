"""Conversation structure repair as a shortest path found by an auction.

A conversation's rows, ordered by turn (null turns first, equal turns by role, then text), form a
lattice: layer ``i`` lies before row ``i``; its four nodes say what the repaired conversation holds
so far - nothing, a system row, an open user row, or an answered one.  Arcs are the edits, with
integer costs: Keep 0, Rerole (to user or assistant) 1, Delete 2, Insert (an empty user or
assistant row) 5, and 5 more for a truncated row that is not deleted; blank and duplicate rows can
only be deleted.  The repaired roles read ``(s?(ua)+)?``.

The auction keeps one price a node with ``price(i) <= cost(i, j) + price(j)`` on every arc.  A path
grows from an origin along an arc on which this is an equality; where there is none, the price of
the path's last node rises to the least ``cost + price`` and the path steps back.  When it arrives,
the origin's price is its distance to the end, and every arc of every shortest path is tight.
Among paths of tight arcs that arrive, the one whose edit initials are ASCII-least is traced.

Long conversations are cut into blocks of ``BLOCK`` rows, solved from the last to the first: the
four prices at the head of a block are the costs of leaving the block before, so the work grows
with the rows, not with their square.

Faults, first one counts: blank (no character other than ``[\\x20\\x09-\\x0D]``), duplicate (role
and text seen earlier in the conversation), truncated (the last such character is none of
``.!?``).

How the work spreads: rows are shuffled once by conversation, and sorted there by Spark; a task reads them as a stream and
holds one conversation at a time.  Its audit and repaired rows are one value each, as its text is.

Defined results: a null role or text counts as one space; a row whose role starts with none of
s, u, a cannot be kept as it is; null ``conv_id`` rows form one conversation; repeated rows are
duplicates; a conversation without rows left has zeros, an empty audit and no rows; an empty table
gives an empty result; further columns are not part of the result.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import schema, small_batches

BLANKS = " \t\n\x0b\x0c\r"
BLOCK = 32                                  # rows whose lattice is held at once
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
EMPTY, SYSTEM, USER, ANSWERED = range(4)
AFTER = {USER: ANSWERED}                    # rerole and insert: an open user row is answered, else one is opened
NAMES = {USER: "user", ANSWERED: "assistant"}
INITIAL = {"s": (SYSTEM, (EMPTY,)), "u": (USER, (EMPTY, SYSTEM, ANSWERED)), "a": (ANSWERED, (USER,))}
DROPPED = "d"                               # code of a row that must be deleted; else the initial, upper-case if truncated
CHUNK = 512                                 # conversations an output batch
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _arcs(codes, exits):
    """Arcs (cost, edit, head) of a block's lattice by node; node = 4 * layer + state, the end last.

    ``exits`` are the costs of leaving from the last layer, or None at the conversation's end.
    """
    end = 4 * (len(codes) + 1)
    arcs = [[] for _ in range(end)]
    for layer in range(len(codes) + 1):
        inside = layer < len(codes)
        code = codes[layer] if inside else ""
        extra = TRUNCATED if code.isupper() else 0
        target, sources = INITIAL.get(code.lower(), (None, ()))
        for state in range(4):
            out, head = arcs[4 * layer + state], 4 * (layer + 1)
            following = AFTER.get(state, USER)
            if inside:
                out.append((DELETE, "D", head + state))
                if state in sources:
                    out.append((KEEP + extra, "K", head + target))
                if code != DROPPED:
                    out.append((REROLE + extra, "R", head + following))
            elif exits is not None:
                out.append((exits[state], "", end))
            elif state in (EMPTY, ANSWERED):
                out.append((0, "", end))
            if inside or exits is None:
                out.append((INSERT, "I", 4 * layer + following))
    return arcs


def auction(arcs, prices, origin, end):
    """Raise ``prices`` (feasible) until a path of tight arcs leads from ``origin`` to ``end``."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        least, head = min((cost + prices[j], j) for cost, _, j in arcs[node])
        if prices[node] < least:            # no tight arc: the price rises, the path steps back
            prices[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)


def _block_prices(codes, exits):
    arcs = _arcs(codes, exits)
    # what must be deleted from a layer on is a feasible first price
    floor = min(exits) if exits is not None else 0
    prices = array("q", [0]) * (len(arcs) + 1)
    for layer in range(len(codes), -1, -1):
        floor += DELETE if layer < len(codes) and codes[layer] == DROPPED else 0
        prices[4 * layer:4 * layer + 4] = array("q", [floor] * 4)
    for origin in range(4):
        auction(arcs, prices, origin, len(arcs))
    return prices


def _trace(codes, exits, prices, state):
    """Edit initials of the ASCII-least path of tight arcs from ``state``, and the state it ends in."""
    arcs = _arcs(codes, exits)
    end = len(arcs)
    tight = [sorted((edit, j) for cost, edit, j in out if prices[i] == cost + prices[j]) for i, out in enumerate(arcs)]
    arrives = [False] * end + [True]
    for layer in range(len(codes), -1, -1):
        for _ in range(3):                  # inserts stay in the layer, at most two in a row
            for i in range(4 * layer, 4 * layer + 4):
                arrives[i] = any(arrives[j] for _, j in tight[i])
    audit, node = [], state
    while node != end:
        edit, head = next((e, j) for e, j in tight[node] if arrives[j])
        audit.append(edit)
        node, state = head, node % 4
    return "".join(audit), state


def cheapest(codes: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows given by their codes."""
    cuts = range(0, max(len(codes), 1), block)
    solved, exits = [], None
    for at in reversed(cuts):
        prices = _block_prices(codes[at:at + block], exits)
        solved.append((codes[at:at + block], exits, prices))
        exits = list(prices[:4])
    audit, state = [], EMPTY
    for part, leave, prices in reversed(solved):
        edits, state = _trace(part, leave, prices, state)
        audit.append(edits)
    return exits[EMPTY], "".join(audit)


def _apply(audit, rows):
    """The repaired (role, text) rows."""
    out, state, at = [], EMPTY, 0
    for edit in audit:
        if edit == "I":
            state = AFTER.get(state, USER)
            out.append((NAMES[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "K":
            state = INITIAL[role[0]][0]
            out.append((role, text))
        elif edit == "R":
            state = AFTER.get(state, USER)
            out.append((NAMES[state], text))
    return out


def _judge(turns, rows, known):
    """The counts, audit and repaired rows of a conversation."""
    counts, codes, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, [], set()
    for role, text in rows:
        words = text.strip(BLANKS)
        fault = ("blank" if not words else "duplicate" if (role, text) in seen
                 else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        initial = role[:1] if role[:1] in INITIAL else "x"
        codes.append(DROPPED if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
    codes = "".join(codes)
    if codes not in known:
        if len(known) > 1 << 16:
            known.clear()
        known[codes] = cheapest(codes)
    cost, audit = known[codes]
    given = [t for t in turns if t is not None]
    gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, _apply(audit, rows))


def _results(batches, kind):
    repaired = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def batch(found):
        ids, results = zip(*found)
        columns = [pa.array(ids, kind)] + [pa.array([r[i] for r in results], pa.int64()) for i in range(6)]
        columns.append(pa.array([r[6] for r in results], pa.string()))
        columns.append(pa.array([[{"role": a, "text": b} for a, b in r[7]] for r in results], repaired))
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", *COUNTS, "audit", "repaired"])

    known, found, current, turns, rows, begun = {}, [], None, [], [], False
    for part in batches:
        for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in part.columns)):
            if not begun or conv != current:
                if begun:
                    found.append((current, _judge(turns, rows, known)))
                    if len(found) == CHUNK or len(rows) > CHUNK:
                        yield batch(found)
                        found = []
                current, turns, rows, begun = conv, [], [], True
            if not gone:
                turns.append(turn)
                rows.append((role, text))
    if begun:
        found.append((current, _judge(turns, rows, known)))
        yield batch(found)


def repair(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (role and text rows).

    ``rows`` have conv_id, turn, role and text; rows for which ``gone`` holds only name their conversation.
    """
    small_batches(rows.sparkSession)
    gone = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    picked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                         F.when(~gone, F.coalesce("role", F.lit(" "))).alias("role"),
                         F.when(~gone, F.coalesce("text", F.lit(" "))).alias("text"), gone.alias("gone"))
    ordered = picked.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    made = schema(", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired array<struct<role:string,text:string>>")
    out = T.StructType([rows.schema["conv_id"], *made.fields])
    kind = pa.string() if isinstance(out.fields[0].dataType, T.StringType) else pa.int64()
    return ordered.mapInArrow(lambda it: _results(it, kind), out)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone of conversations damaged by crc32(conv_id:turn) % 20 (nulls: one space):
    0 gone, 1 text emptied, 2 its ``.!?`` removed, 3 repeated, 4 role user; other rows as they are."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    picked = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), harm.alias("harm"))
    text = (F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return picked.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
                         text.alias("text"), (F.col("harm") == 0).alias("gone"), copies.alias("copy")).drop("copy")


# DuckDB: the same rows by a backward recursion over the rows.  At each layer and state (e: empty,
# s: system, u: open user row, a: answered) it holds the least {cost, audit}.
def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"


def _way(cost: str, edit: str, rest: str, when: str = "true") -> str:
    return f"CASE WHEN {when} THEN {{'c': {rest}.c + {cost}, 'a': '{edit}' || {rest}.a}} END"


def _row(state: str, following: str, keeps: dict[str, str]) -> str:
    kept = [_way("r.extra", "K", f"b.{q}", f"r.code = '{i}'") for i, q in keeps.items()]
    return _least(_way("2", "D", f"b.{state}"), *kept, _way("1 + r.extra", "R", f"b.{following}", "r.code <> 'd'"))


REPAIR_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(generate_series(1, length(k)),
              lambda i: [ascii(substr(k, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END),
            4294967295::BIGINT) % 20 AS harm FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(generate_series(1, CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE harm <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS i,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words FROM damaged),
judged AS (
  SELECT *, CASE WHEN words = '' THEN 'blank' WHEN pos > first_pos THEN 'duplicate'
                 WHEN right(words, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM (SELECT *, min(pos) OVER (PARTITION BY conv_id, role, text) AS first_pos FROM ordered)),
coded AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' ELSE i END AS code,
         CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END::BIGINT AS extra FROM judged),
best AS (
  SELECT conv_id, pos, {{'c': 0::BIGINT, 'a': ''}} AS e, {{'c': 10::BIGINT, 'a': 'II'}} AS s,
         {{'c': 5::BIGINT, 'a': 'I'}} AS u, {{'c': 0::BIGINT, 'a': ''}} AS a FROM coded WHERE pos = n
  UNION ALL
  SELECT conv_id, pos, {_least('e', _way('5', 'I', 'u'))}, {_least('s', _way('5', 'I', 'u'))}, u, a
  FROM (SELECT conv_id, pos, e, s, {_least('u', _way('5', 'I', 'a'))} AS u, {_least('a', _way('5', 'I', 'u'))} AS a
        FROM (SELECT b.conv_id, b.pos - 1 AS pos, {_row('e', 'u', {'s': 's', 'u': 'u'})} AS e,
                     {_row('s', 'u', {'u': 'u'})} AS s, {_row('u', 'a', {'a': 'a'})} AS u,
                     {_row('a', 'u', {'u': 'u'})} AS a
              FROM best b JOIN coded r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.pos = b.pos))),
solved AS (SELECT conv_id, e.c AS cost, e.a AS audit FROM best WHERE pos = 0),
edits AS (
  SELECT conv_id, unnest(generate_series(1, length(audit))) AS j, unnest(string_split(audit, '')) AS edit
  FROM solved WHERE audit <> ''),
placed AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS pos,
         count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS place FROM edits),
rows_of AS (
  SELECT p.conv_id, p.j, p.edit, p.place, c.role, c.text,
         max(CASE WHEN p.place = 1 AND p.edit = 'K' AND c.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS led
  FROM placed p LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.pos = p.pos AND p.edit <> 'I'
  WHERE p.edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS out
  FROM rows_of GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pos > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(s.cost, 0)::BIGINT AS cost, coalesce(s.audit, '') AS audit,
       sha256(coalesce(p.out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""
