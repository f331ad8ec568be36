"""Line deduplication by the number of documents that hold a line.

Every text is cut at ``\\n`` (a null or empty text is one empty line).  The key of a line is the
line without the characters ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z lower-cased.  Keys of
at least ``min_chars`` code points are hashed to 128 bits.  A key found in ``min_docs`` documents
or more loses its lines everywhere but in the largest ``doc_id`` that holds it; what is left of a
text is put together again by line position.

How the work spreads: lines leave the texts as (doc_id, text_key, line, digest) and are counted by
aggregates with partial sums, so a line of a third of all documents is a few rows a task.  A digest
held by more than 1 in ``HOT_SHARE`` of all (digest, document) pairs is one of at most ``HOT_SHARE``
such digests, whatever the corpus; these meet their lines by broadcast, all others in a shuffled
join in which no digest has a larger share.  Texts move once, to meet their dropped positions.

Defined results: lines of a null ``doc_id`` belong to no document, they do not count and all stay.
Rows of one ``doc_id`` are one document: its lines count once, and each row keeps or loses its
own.  Repeated rows stay repeated.  A text that loses all lines becomes empty.  An empty table
gives an empty result; further columns are passed on, whatever their names (only ``kept``,
``n_lines`` and ``n_dropped`` are replaced).
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import let, schema, small_batches, stored

MIN_CHARS = 20
MIN_DOCS = 3
HOT_SHARE = 4096
BLANKS = b" \t\n\x0b\x0c\r"
MADE = ("kept", "n_lines", "n_dropped")


def line_key(line: bytes) -> bytes:
    """The key of a UTF-8 line: ends stripped, A-Z lower-cased (bytes.lower leaves all else)."""
    return line.strip(BLANKS).lower()


def _long_lines(batches, min_chars):
    for batch in batches:
        rows, at, hi, lo = [], [], [], []
        for row, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
            for place, line in enumerate(text.split(b"\n")):
                key = line_key(line)
                # a key has at most as many code points as bytes
                if len(key) < min_chars or len(key.decode("utf-8", "replace")) < min_chars:
                    continue
                d = xxhash.xxh3_128_intdigest(key)
                rows.append(row)
                at.append(place)
                hi.append((d >> 64) - (1 << 63))
                lo.append((d & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(at, pa.int32()),
             pa.array(hi, pa.int64()), pa.array(lo, pa.int64())],
            names=["doc_id", "text_key", "line", "hi", "lo"])


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key of ``min_chars`` or more: doc_id, text_key, line (from 0), hi, lo."""
    small_batches(docs.sparkSession)
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return texts.mapInArrow(lambda it: _long_lines(it, min_chars),
                            schema("doc_id long, text_key long, line int, hi long, lo long"))


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS, hot_share: int = HOT_SHARE) -> DataFrame:
    """doc_id, text_key, line of the lines to drop, from the (stored) rows of ``long_lines``."""
    held = (lines.select("hi", "lo", "doc_id").distinct().groupBy("hi", "lo")
            .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
            .where(F.col("n") >= min_docs))
    held = stored(held, "held-lines")
    total = held.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(held.where(F.col("n") * hot_share > total).drop("n"))
    rest = held.where(F.col("n") * hot_share <= total).drop("n")
    common = lines.join(hot, ["hi", "lo"])
    others = lines.join(hot.select("hi", "lo"), ["hi", "lo"], "left_anti").join(rest, ["hi", "lo"])
    return common.unionByName(others).where("doc_id != keeper").select("doc_id", "text_key", "line")


def drop_common_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with kept (the text without its dropped lines), n_lines (before) and n_dropped."""
    gone = dropped_lines(stored(long_lines(docs, min_chars), "long-lines"), min_docs)
    # equal texts of one id have equal positions, so a set per (id, text) serves all of them
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set("line").alias("_gone"))
    names = [c for c in docs.columns if c not in MADE]
    rows = docs.select(F.struct(*names).alias("_row"))
    rows = rows.join(gone, (F.col("_row.doc_id").cast("long") == F.col("_id"))
                     & (F.xxhash64("_row.text") == F.col("_key")), "left")

    def cut(lines):
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
        text = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        return F.struct(F.when(F.col("_gone").isNull(), F.coalesce("_row.text", F.lit("")))
                        .otherwise(text).alias("kept"), F.size(lines).cast("long").alias("n_lines"))
    made = let(F.split(F.coalesce("_row.text", F.lit("")), "\n"), cut)
    gone_here = F.coalesce(F.size("_gone"), F.lit(0))
    return rows.select("_row", made.alias("_made"), F.greatest(gone_here, F.lit(0)).cast("long").alias("_n")).select(
        *[F.col("_row").getField(c).alias(c) for c in names], "_made.kept", "_made.n_lines",
        F.col("_n").alias("n_dropped"))


# DuckDB: the same rows from the contract, without hashes or broadcasts.
LINE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
              FROM documents),
lines AS (SELECT rid, doc_id, unnest(generate_series(1, len(lines))) AS pos, unnest(lines) AS line FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
         GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, coalesce(k.doc_id <> h.keeper, false) AS gone FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid, doc_id
"""
