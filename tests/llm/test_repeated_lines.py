"""Lines held by several documents, against a plain count over the whole table."""

import hashlib
import re
from collections import defaultdict

from eventide.llm import repeated_lines


def _key(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m.group().lower(), line)


def plain(rows, min_chars=20, min_docs=3):
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(_key(line)) >= min_chars:
                held[_key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if i is None or len(held.get(_key(x), ())) < min_docs or max(held[_key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    from pyspark.sql import functions as F
    rows = frame.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    return sorted((tuple(r) for r in rows), key=str)


LONG = "a line of more than twenty characters"
ROWS = [
    (1, f"{LONG}\nfirst"), (2, f"\t {LONG.upper()} \r\nsecond\n{LONG}"), (3, f"third\n{LONG}\n"), (9, f"{LONG}\n{LONG}"),
    (4, "É" * 19 + "\n" + "É" * 20), (5, "É" * 20 + "\n" + "é" * 20), (6, "É" * 20), (7, "É" * 19), (8, "É" * 19 + "x"),
    (10, None), (11, ""), (12, "\n\n"), (13, " " * 30), (14, " " * 30), (15, " " * 30),
    (None, LONG), (None, None),
    (16, "nineteen characters"), (17, "nineteen characters"), (18, "nineteen characters"),
    (19, "only in two documents, twice\nonly in two documents, twice"), (20, "only in two documents, twice"),
    (21, LONG), (21, LONG), (21, f"own words of the same id\n{LONG}"),     # repeated rows and ids
    (22, "x" * 300_000 + "\n" + LONG + "\n" + "y\n" * 20_000),
]


def test_like_the_plain_count(spark, docs):
    assert got(repeated_lines.drop_common_lines(docs(ROWS))) == plain(ROWS)
    assert sum(r[2] for r in plain(ROWS)) > 5


def test_hot_and_other_digests_agree(spark, docs):
    rows = [(i, "\n".join(f"common line number {j} of many" for j in range(i % 7))) for i in range(60)]
    lines = repeated_lines.long_lines(docs(rows))
    ways = [sorted(map(tuple, repeated_lines.dropped_lines(lines, hot_share=s).collect())) for s in (0, 5, 1 << 40)]
    assert ways[0] == ways[1] == ways[2] != []
    assert got(repeated_lines.drop_common_lines(docs(rows))) == plain(rows)


def test_columns_pass_and_empty_table(spark, docs):
    frame = docs(ROWS).selectExpr("*", "'a' AS kept", "1 AS _row", "2 AS _gone", "3 AS line", "4 AS hi", "5 AS _id")
    out = repeated_lines.drop_common_lines(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "_row", "_gone", "line", "hi", "_id", "kept", "n_lines", "n_dropped"]
    assert {(r["_row"], r["_gone"], r["line"], r["hi"], r["_id"]) for r in out.collect()} == {(1, 2, 3, 4, 5)}
    assert got(out) == plain(ROWS)
    assert repeated_lines.drop_common_lines(docs([])).count() == 0
