"""Substring deduplication by hashing lines and content-defined pieces.

Each text is cut into its lines.  A line of at least ``min_words`` words is a unit: it is
normalised (case folded, blanks collapsed) and hashed to 128 bits.  For passages that start or
end inside a line there are pieces, whatever the lines: a word that with its next one is of a
chosen hash class (one in ``CLASSES``) is a cut, and from each cut a piece runs to the first cut
``min_words`` or more words on.  Pieces overlap, depend on nothing before them, and are
normalised and hashed alike.  Units are grouped over the whole corpus by digest; the occurrence
of the lowest rank (document id, then position) stays, all others are removed from their
documents.  What was removed keeps its offsets in the original text and a document that holds an
earlier copy: whole lines with their line break, and runs of repeated pieces, line by line.  A
line of which a run leaves only blanks goes with its line break.

Of a repeated passage without whole lines, the words before its first cut and after its last stay.

Digests are counted by an aggregate with map-side partial sums, so a line that stands in a
third of all documents is a few rows a task; only repeated digests meet their occurrences
again, in a join that adaptive execution can split.

Defined results: a null text stays null; an empty text has no units; rows of one id and equal
text are the same document and lose the same words; null ids rank last; an empty table gives
an empty result; further columns are passed on.
"""

from __future__ import annotations

import re
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import schema, small_batches, stored

MIN_WORDS = 8
CLASSES = 16                    # one word in so many is a cut
PIECE = 1 << 40                 # units from here on are pieces, by their first word
REMOVED = "array<struct<unit:bigint,start:bigint,length:bigint,first_doc_id:bigint>>"


def _pieces(text, min_words):
    """(first word, start, length, digest) of the pieces of a text."""
    words = text.casefold().split()
    cuts = [i for i, (a, b) in enumerate(zip(words, words[1:])) if not crc32(f"{a} {b}".encode()) % CLASSES]
    if len(cuts) < 2:
        return
    at = [m.span() for m in re.finditer(r"\S+", text)]
    k = 0
    for i in cuts:
        while k < len(cuts) and cuts[k] < i + min_words:
            k += 1
        if k == len(cuts):
            return
        j = cuts[k]
        # the seed keeps pieces apart from lines
        yield i, at[i][0], at[j - 1][1] - at[i][0], xxhash.xxh3_128_intdigest(" ".join(words[i:j]), 1)


def _units(batches, min_words):
    for batch in batches:
        rows = [[] for _ in range(6)]

        def add(*values, d):
            for column, x in zip(rows, (*values, (d >> 64) - (1 << 63), (d & 0xFFFFFFFFFFFFFFFF) - (1 << 63))):
                column.append(x)
        for row, text in enumerate(batch.column(2).to_pylist()):
            start = 0
            for k, line in enumerate(text.split("\n")):
                words = line.casefold().split()
                if len(words) >= min_words:
                    add(row, k, start, len(line), d=xxhash.xxh3_128_intdigest(" ".join(words)))
                start += len(line) + 1
            for i, start, length, d in _pieces(text, min_words):
                add(row, PIECE + i, start, length, d=d)
        at = pa.array(rows[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(c, pa.int64()) for c in rows[1:]]],
            names=["doc_id", "text_key", "unit", "start", "length", "hi", "lo"])


def _cut(text, gone):
    """The text without the repeated units, and what was removed: (line, start, length, first_doc_id)."""
    whole = {g["unit"]: g for g in gone if g["unit"] < PIECE}
    runs = []                   # start, end, first_doc_id
    for g in sorted((g for g in gone if g["unit"] >= PIECE), key=lambda g: g["start"]):
        end = g["start"] + g["length"]
        if runs and g["start"] <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([g["start"], end, g["first_doc_id"]])
    left, removed, start, k = [], [], 0, 0
    for n, line in enumerate(text.split("\n")):
        end = start + len(line)
        while k < len(runs) and runs[k][1] <= start:
            k += 1
        if n in whole:
            removed.append((n, start, len(line), whole[n]["first_doc_id"]))
        else:
            parts, at, r = [], start, k
            while r < len(runs) and runs[r][0] < end:
                a, b = max(runs[r][0], start), min(runs[r][1], end)
                parts.append(text[at:a])
                removed.append((n, a, b - a, runs[r][2]))
                at, r = b, r + 1
            rest = "".join(parts) + text[at:end]
            if not parts or rest.strip():
                left.append(rest)
        start = end + 1
    return "\n".join(left), removed


def _without(batches, place):
    """The rows with their text cut, n_removed and removed in place of gone (the last column)."""
    for batch in batches:
        texts, gone = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        cut = [_cut(t, g) if g else (t, []) for t, g in zip(texts, gone)]
        names = ("unit", "start", "length", "first_doc_id")
        columns = list(batch.columns[:-1])
        columns[place] = pa.array([t for t, _ in cut], batch.column(place).type)
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in names]))
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([len(g) for _, g in cut], pa.int32()),
             pa.array([[dict(zip(names, x)) for x in g] for _, g in cut], kind)],
            names=[*batch.schema.names[:-1], "n_removed", "removed"])


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated unit, lines and pieces: doc_id, text_key, unit, start, length, first_doc_id."""
    small_batches(docs.sparkSession)
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    units = stored(texts.mapInArrow(
        lambda it: _units(it, min_words),
        schema("doc_id long, text_key long, unit long, start long, length long, hi long, lo long")), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "unit")
    firsts = (units.groupBy("hi", "lo").agg(F.min(rank).alias("first"), F.max(rank).alias("final"))
              .where("first < final").select("hi", "lo", "first"))
    found = units.join(firsts, ["hi", "lo"]).where(rank != F.col("first"))
    return found.select("doc_id", "text_key", "unit", "start", "length",
                        F.col("first.doc_id").alias("first_doc_id")).distinct()


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its texts deduplicated, n_removed, and removed (offsets in the original)."""
    gone = repeated_units(docs, min_words)
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct("unit", "start", "length", "first_doc_id")).alias("_gone"))
    kept = [c for c in docs.columns if c not in ("n_removed", "removed")]
    rows = docs.select(*kept).join(
        gone, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left")
    rows = rows.select(*kept, "_gone")
    made = [T.StructField("n_removed", T.IntegerType()), T.StructField("removed", schema(REMOVED))]
    place = kept.index("text")
    return rows.mapInArrow(lambda it: _without(it, place), T.StructType(rows.schema.fields[:-1] + made))
