"""Lempel-Ziv phrase fingerprints of documents.

A text's bytes are parsed into the phrases of an LZ78 dictionary: each phrase is the shortest
string not seen before.  The phrases are hashed, and the fingerprint is the sorted list of the
``k`` smallest hashes (32 bits each, as hex).  Two fingerprints give an estimate of the Jaccard
similarity of the phrase sets: the share of hashes found in both among the ``k`` smallest of
their union, exact while the union has no more than ``k`` phrases.  Texts that compress each
other well share phrases.

``fingerprint_edits`` compares each document with an edited form of itself and with its
successor in id order.  The order is made without a global sort in one task: ids are cut into
ranges, each range is sorted in its task, and the first document of every range is also sent
to the range before it.  Only range bounds (a few numbers per range) pass the driver.

Defined results: a null text counts as empty; an empty text has an empty fingerprint, alike 1.0
to another empty one and 0.0 to any other; null ids sort first; equal ids sort by text; repeated
rows give one row each; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import literal_array, schema, small_batches

K = 128
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


class Parse:
    """State of an LZ78 parse: a trie of phrases with the hash of each phrase."""

    def __init__(self):
        self.nodes, self.hashes, self.at = {}, [1], 0

    def copy(self) -> Parse:
        other = Parse.__new__(Parse)
        other.nodes, other.hashes, other.at = self.nodes.copy(), self.hashes.copy(), self.at
        return other

    def feed(self, data: bytes) -> Parse:
        nodes, hashes, at = self.nodes, self.hashes, self.at
        get = nodes.get
        for c in data:
            key = at | c
            at = get(key)
            if at is None:
                nodes[key] = len(hashes) << 8
                hashes.append((hashes[key >> 8] * 1000003 + c + 1) & 0xFFFFFFFFFFFF)
                at = 0
        self.at = at
        return self

    def minima(self, k: int = K) -> np.ndarray:
        """The k smallest phrase hashes, ascending."""
        x = np.array(self.hashes[1:], np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)
        if len(x) > 4 * k:
            x = np.partition(x, 2 * k)[:2 * k]
        return np.unique(x)[:k]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    union = np.unique(both)[:k]
    twice = both[1:][both[1:] == both[:-1]]
    return float(np.searchsorted(twice, union[-1], "right")) / len(union)


def in_order(docs: DataFrame, parts_per_task: int = 4) -> DataFrame:
    """(part, tail, doc_id, text) in sorted partitions; ``tail`` rows open the next part."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = tasks * parts_per_task
    cuts = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n)
    cuts = sorted({int(c) for c in cuts})
    part = F.lit(0)
    if cuts:
        part = F.size(F.filter(literal_array(cuts, "bigint"), lambda c: c < F.col("doc_id")))
    docs = docs.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
    heads = sorted((r["part"], r["h"]["doc_id"]) for r in
                   docs.groupBy("part").agg(F.min(F.struct("doc_id")).alias("h")).collect())
    rows = [F.struct(F.col("part"), F.lit(False).alias("tail"))]
    before = {p: heads[i - 1][0] for i, (p, _) in enumerate(heads)}
    if heads:
        size = len(cuts) + 1
        first = dict(heads)
        head = F.get(literal_array([first.get(p) if first.get(p) is not None else 0 for p in range(size)],
                                   "bigint"), F.col("part"))
        head = F.when((F.col("part") == 0) & F.lit(first.get(0) is None), F.lit(None)).otherwise(head)
        prev = F.get(literal_array([before.get(p, 0) for p in range(size)], "int"), F.col("part"))
        rows.append(F.when(F.col("doc_id").eqNullSafe(head), F.struct(prev.alias("part"), F.lit(True).alias("tail"))))
    docs = docs.withColumn("_to", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())))
    docs = docs.select("_to.part", "_to.tail", "doc_id", "text")
    return docs.repartition(tasks, "part").sortWithinPartitions("part", "tail", "doc_id", "text")


def _fingerprints(batches, k: int = K):
    def hexed(m):
        return m.astype(">u4").tobytes().hex()

    def pair(cur, nxt):
        """One result row; fills in the successor's own parse."""
        doc_id, text, sig, head = cur
        own = nxt[1] if nxt is not None else text
        half = len(text) // 2
        kept = text[:len(text) - half]
        edited = head.feed(own[:half].encode()).minima(k)
        return (doc_id, len(text), hashlib.sha256((kept + own[:half]).encode()).hexdigest(), hexed(sig),
                hexed(edited), likeness(sig, edited, k), likeness(sig, nxt[2], k) if nxt is not None else 1.0)

    def parsed(doc_id, text):
        half = len(text) // 2
        head = Parse().feed(text[:len(text) - half].encode())
        return doc_id, text, head.copy().feed(text[len(text) - half:].encode()).minima(k), head

    out, cur, at, closed = [], None, None, False
    out_schema = _arrow_schema()
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for part, tail, doc_id, text in zip(*cols):
            if part != at:
                cur, at, closed = None, part, False
            if closed:                      # further rows that open the next part
                continue
            nxt = parsed(doc_id, text)
            if cur is not None:
                out.append(pair(cur, nxt))
            closed, cur = tail, nxt
            if len(out) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), out_schema.types)],
                                                 schema=out_schema)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), out_schema.types)],
                                         schema=out_schema)


def _arrow_schema():
    s = pa.string()
    return pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", s), ("fingerprint", s),
                      ("edited_fingerprint", s), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last half of the code points
    replaced by as many from the start of the next document), and the likenesses."""
    small_batches(docs.sparkSession)
    return in_order(docs).mapInArrow(_fingerprints, schema(RESULT))


def fingerprints(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """``docs`` with a column ``fingerprint`` of the text column (no shuffle)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def fingerprint(texts):
        return texts.map(lambda t: Parse().feed((t or "").encode()).minima(k).astype(">u4").tobytes().hex())

    return docs.withColumn("fingerprint", fingerprint(F.coalesce(F.col(text), F.lit(""))))


def same(a: str, b: str, k: int = K) -> float:
    """Likeness of two fingerprint strings."""
    read = lambda s: np.frombuffer(bytes.fromhex(s), ">u4").astype(np.uint32)
    return likeness(read(a), read(b), k)
