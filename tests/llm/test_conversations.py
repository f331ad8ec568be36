"""Conversation repair, against an exhaustive search over all edit strings."""

import hashlib
import heapq
import random
import re
import time
import zlib

from pyspark.sql import functions as F

from eventide.llm import catalog, conversations

WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_cheapest(codes):
    """Least (cost, audit) by a best-first search over whole edit strings."""
    queue, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, at, state = heapq.heappop(queue)   # ties: the ASCII-least string first
        if (at, state, audit) in seen:
            continue
        seen.add((at, state, audit))
        if at == len(codes) and state in ("", "a"):
            return cost, audit
        opened = state in ("", "s", "a")
        heapq.heappush(queue, (cost + 5, audit + "I", at, "u" if opened else "a"))
        if at == len(codes):
            continue
        code, extra = codes[at].lower(), 5 * codes[at].isupper()
        heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state))
        if code == "d":
            continue
        heapq.heappush(queue, (cost + 1 + extra, audit + "R", at + 1, "u" if opened else "a"))
        if code == "s" and state == "" or code == "u" and opened or code == "a" and state == "u":
            heapq.heappush(queue, (cost + extra, audit + "K", at + 1, code))


def test_auction_finds_the_least_of_all_strings():
    rng = random.Random(5)
    for n in range(7):
        for _ in range(60):
            codes = "".join(rng.choice("suauauaxdSUAX") for _ in range(n))
            want = plain_cheapest(codes)
            for block in (1, 2, 3, 32):
                assert conversations.cheapest(codes, block) == want, codes


def test_blocks_agree_and_work_is_linear():
    rng = random.Random(6)
    codes = "".join(rng.choice("suauauauauadUA") for _ in range(700))
    assert len({conversations.cheapest(codes, b) for b in (5, 32, 1000)}) == 1
    spent = []
    for n in (4000, 16000):
        codes = "".join(rng.choice("uauauauaudUAs") for _ in range(n))
        start = time.process_time()
        conversations.cheapest(codes)
        spent.append(time.process_time() - start)
    assert spent[1] < 10 * spent[0]


def plain(rows):
    """The contract row by row: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}."""
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        row = (turn, "user" if harm == 4 else role,
               "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
        convs[conv] += [row] * (0 if harm == 0 else 2 if harm == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen, counts = "", set(), [0, 0, 0]
        for _, role, text in held:
            marks = WORD.findall(text)
            fault = 0 if not marks else 1 if (role, text) in seen else 2 if marks[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in (0, 1) else code.upper() if fault == 2 else code
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[1][:1] for r in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit = plain_cheapest(codes)
        fixed, at = [], 0
        for e in audit:
            turn_of = "user" if not fixed or fixed[-1][0][0] in "sa" else "assistant"
            if e == "I":
                fixed.append((turn_of, ""))
            else:
                if e != "D":
                    fixed.append((held[at][1] if e == "K" else turn_of, held[at][2]))
                at += 1
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def query_rows(spark, tmp_path, rows, extra=()):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", *extra).write.parquet(str(tmp_path / "conversations.parquet"))
    got = catalog.op11_conversations(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


EDGES = [
    (1, None, None, None), (1, None, "user", "Hi there."), (1, 3, "user", "Hi there."), (1, 3, "user", "Hi there."),
    (1, 3, "assistant", "  "), (1, 9, "tool", "Result!"), (2, 0, "system", "Be good."), (3, 0, "assistant", "x"),
    (4, 5, "", "no role."), (4, 5, "User", "upper."), (5, 0, "user", "a "), (5, 1, "assistant", "b. "),
    (None, 1, "user", "null id."), (None, 2, "assistant", "null id."), (6, 1, "user", "first"), (6, 1, "assistant", "same turn"),
    (7, 1, "user", "Q? " * 100_000), (7, 2, "assistant", "A " * 100_000), (8, 2**62, "user", "q."), (8, -2**62, "agent", "a."),
] + [(9, t, "user" if t % 3 else "assistant", f"row {t}.") for t in range(60)] + [(10, t, None, None) for t in range(12)]


def test_edges_like_the_plain_rule(spark, tmp_path):
    small = [r for r in EDGES if r[0] != 9]
    clash = ("1 AS gone", "2 AS harm", "3 AS copy", "4 AS cost", "'a' AS audit")
    assert query_rows(spark, tmp_path, small, clash) == plain(small)


def test_random_conversations_like_the_plain_rule(spark, tmp_path):
    rng = random.Random(7)
    rows = [(c, rng.choice([None, t, t, t, t // 2]), rng.choice(["user", "assistant", "user", "assistant", "system", None]),
             rng.choice(["Well.", "Yes!", "no stop", "", "Well.", None, f"Text {t}."]))
            for c in range(150) for t in range(rng.randint(1, 6))]
    assert query_rows(spark, tmp_path, rows) == plain(rows)


def test_long_conversation_and_empty_table(spark, tmp_path):
    rows = [(1, t, "user" if t % 2 else "assistant", f"row {t % 4000}.") for t in range(6000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conversations.repair(frame).collect()[0]
    assert got["duplicate"] == 2000 and got["audit"] == "D" + "K" * 3998 + "D" * 2001 and got["cost"] == 2002 * 2
    assert [r["text"] for r in got["repaired"]] == [f"row {t}." for t in range(1, 3999)]
    empty = conversations.repair(frame.where("turn < 0"))
    assert empty.count() == 0
    gone = conversations.repair(frame, F.lit(True)).collect()[0]
    assert tuple(gone)[1:] == (0, 0, 0, 0, 0, 0, "", [])
