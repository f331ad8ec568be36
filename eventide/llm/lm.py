"""Language-model scores of documents: prediction by partial matching over bytes.

Training counts all byte contexts of the training texts with Spark (each task counts its share,
a shuffle adds up).  The trie is ``max_depth`` deep at any size of the corpus.  One of at most
``shipped`` nodes is broadcast.  A larger one stays a table: the commonest nodes are broadcast
with their values, at most ``shipped``, and so are the counts of depth 2 (at most 2**24 nodes).
The other codes of the texts meet the trie where their last three context bytes are dealt to: all
longer contexts lie there, all shorter ones in the counts of depth 2.  Their values are joined to
the documents.  Both ways give the same scores.  Every training byte counts at every depth.

Only a caller who gives ``max_nodes`` gets a shallower trie, the deepest of that many nodes.

Beside the model a smoothed unigram base is kept: the sum over a text's words and its end of
log10((c + 1) / (N + V + 1)).  The vocabulary grows with the corpus and is never gathered:
only the ``frequent`` most common words are broadcast (a fixed number of 64-bit hashes); the
counts of all other words are joined by hash to the words of each document.

Letters A-Z are lower-cased.  Words are told apart by a 64-bit hash of their bytes.
Defined results: a null text counts as empty and still has its end; with nothing to learn from
all counts are 0 and every byte has probability 1 / 255; repeated rows each count and each get
a row; a null id is in the training part (its checksum is 0); further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import ppm
from eventide.llm.common import by_bytes, schema, small_batches, stored

MAX_DEPTH = 5               # codes of 6 bytes
SHIPPED = 1 << 22           # nodes that are broadcast
BASE = 2                    # depth whose counts are always broadcast
BLOCK = 1 << 20             # rows of the trie valued at once
FREQUENT = 1 << 17
WORD, GRAM = 0, 1


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _count(batches):
    words, grams, waiting, size = Counter(), [], [], 0

    def rows(kind, code, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(code), kind, np.int8)), pa.array(code, pa.int64()),
                                           pa.array(n, pa.int64())], names=["kind", "code", "n"])

    def word_rows():
        code = np.fromiter(map(word_hash, words), np.int64, len(words))
        return rows(WORD, code, np.fromiter(words.values(), np.int64, len(words)))

    def gram_parts():
        nonlocal grams, waiting, size
        grams.append(ppm.count_grams(waiting, MAX_DEPTH))
        waiting, size = [], 0
        if sum(len(c) for c, _ in grams) > 6_000_000:
            grams = [ppm.merge_counts(grams)]

    for batch in batches:
        for text in batch.column(0).to_pylist():
            text = text.lower()
            words.update(text.split())
            waiting.append(text)
            size += len(text)
            if size > 2 << 20:
                gram_parts()
            if len(words) > 1_000_000:
                yield word_rows()
                words = Counter()
        if len(grams) == 1 and len(grams[0][0]) > 4_000_000:
            yield rows(GRAM, *grams.pop())
    if waiting:
        gram_parts()
    yield word_rows()
    if grams:
        yield rows(GRAM, *ppm.merge_counts(grams))


class Trained:
    """The frozen statistics, the frequent words, and the table of all word counts.

    Of a trie too large to be sent, ``frozen`` has depth ``BASE``, ``near`` the commonest codes of
    full depth with their values, ``grams`` is the table of all, and ``depth`` its depth.
    """

    def __init__(self, frozen, frequent, vocabulary, tokens, kinds, depth=None, near=None, grams=None):
        self.frozen, self.frequent, self.vocabulary = frozen, frequent, vocabulary
        self.tokens, self.kinds = tokens, kinds
        self.depth, self.near, self.grams = frozen.depth if depth is None else depth, near, grams


def _blocks(batches):
    """(place, code, n) of whole places (rows come sorted by place), about ``BLOCK`` rows at once."""
    held, size = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        size += batch.num_rows
        if size >= BLOCK:
            place, code, n = map(np.concatenate, zip(*held))
            last = int(np.searchsorted(place, place[-1]))
            if last:
                yield code[:last], n[:last]
            held, size = [[place[last:], code[last:], n[last:]]], len(place) - last
    if size:
        _, code, n = map(np.concatenate, zip(*held))
        yield code, n


def gram_values(grams: DataFrame, wanted: DataFrame, base: ppm.Frozen, depth: int) -> DataFrame:
    """(code, value): the natural log probability of every code of ``wanted`` (code).

    ``grams`` (code, n) is the whole trie; ``base`` has its counts at depth ``BASE``.
    """
    shared = wanted.sparkSession.sparkContext.broadcast((base.code, base.n))
    # a wanted code has the count 0
    rows = grams.select("code", "n").unionByName(wanted.select("code", F.lit(0).cast("long").alias("n")))
    place = F.shiftrightunsigned("code", 8).bitwiseAND((1 << 8 * (BASE + 1)) - 1)
    rows = rows.select(place.alias("place"), "code", "n").repartition("place").sortWithinPartitions("place")

    def run(batches):
        model = None
        for code, n in _blocks(batches):
            model = model or ppm.Model(*shared.value, BASE)
            ask = code[n == 0]
            if len(ask):
                seen = n > 0
                order = np.argsort(code[seen])
                part = ppm.Model(code[seen][order], n[seen][order], depth, model)
                yield pa.RecordBatch.from_arrays([pa.array(ask), pa.array(part.values(ask).astype(np.float64))],
                                                 names=["code", "value"])

    return rows.mapInArrow(run, schema("code long, value double"))


def _commonest(grams: DataFrame, limit: int) -> DataFrame:
    """The codes of the largest counts, no more than ``limit``; of one count all or none."""
    cells = grams.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).agg(F.count("*").alias("codes")).collect()
    least = (1 << 20) + 1
    for n, codes in sorted(map(tuple, cells), reverse=True):
        limit -= codes
        if limit < 0:
            break
        least = n
    return grams.where(F.col("n") >= least) if least <= 1 << 20 else grams.limit(0)


def fit(docs: DataFrame, max_depth: int = MAX_DEPTH, max_nodes: int | None = None,
        frequent: int = FREQUENT, shipped: int = SHIPPED) -> Trained:
    """Count the texts of ``docs`` (column ``text``)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = stored(texts.mapInArrow(_count, schema("kind byte, code long, n long"))
                    .groupBy("kind", "code").agg(F.sum("n").alias("n")), "lm-counts")
    grams, vocabulary = counts.where(F.col("kind") == GRAM), counts.where(F.col("kind") == WORD)
    depth = min(max_depth, MAX_DEPTH)
    cut = lambda k: (grams.select("code", "n") if k == MAX_DEPTH else
                     grams.groupBy(F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("code"))
                     .agg(F.sum("n").alias("n")))
    while max_nodes is not None and depth > BASE and cut(depth).limit(max_nodes + 1).count() > max_nodes:
        depth -= 1
    sent = depth if depth <= BASE or cut(depth).limit(shipped + 1).count() <= shipped else BASE
    table = cut(sent).toArrow()
    code, n = table["code"].to_numpy(), table["n"].to_numpy()
    del table
    order = np.argsort(code)
    code, n = code[order], n[order]
    ends = int(n[(code & 255) == ppm.END].sum())           # one end a text
    whole = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = vocabulary.orderBy(F.desc("n"), "code").limit(frequent).select("code", "n").toPandas()
    frozen, near, trie = ppm.Frozen(code, n, sent), None, None
    if sent < depth:
        trie = cut(depth)
        got = gram_values(trie, _commonest(trie, shipped), frozen, depth).toArrow()
        near = got["code"].to_numpy(), got["value"].to_numpy().astype(np.float32)
    return Trained(frozen, (top["code"].to_numpy(np.int64), top["n"].to_numpy(np.int64), ends),
                   vocabulary.select("code", "n"), int(whole["n"]) + ends, int(whole["v"]) + (ends > 0),
                   depth, near, trie)


def _near_score(near: ppm.CodeMap, value: np.ndarray, text: bytes, depth: int):
    """Sum of the log probabilities that are at hand; the other codes, and how often each occurs."""
    code = ppm.grams(ppm.lay_out([text], depth)[0], depth + 1)
    code = code[(code & 255) != ppm.START]
    row = near.find(code)
    far, times = np.unique(code[row < 0], return_counts=True)
    return float(value[row[row >= 0]].sum(dtype=np.float64)), far, times


def score(docs: DataFrame, trained: Trained) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, ...)."""
    spark = docs.sparkSession
    small_batches(spark)
    total = trained.tokens
    whole = math.log10(trained.tokens + trained.kinds + 1)
    depth, whole_trie = trained.depth, trained.near is None
    shared = spark.sparkContext.broadcast((trained.frozen if whole_trie else trained.near, *trained.frequent))

    def run(batches):
        frozen, codes, counts, ends = shared.value
        if whole_trie:
            model = frozen.model()
        else:
            near, near_value = ppm.CodeMap(frozen[0]), frozen[1]
        frequent = ppm.CodeMap(codes)
        weight = np.log10(counts + 1.0) - whole
        end = math.log10(ends + 1) - whole
        hashes: dict[bytes, int] = {}
        for batch in batches:
            texts = [t.lower() for t in batch.column(1).to_pylist()]
            n_tokens, known, base, rare, rare_n = [], [], [], [], []
            for t in texts:
                seen = Counter(t.split())
                for w in seen:
                    if w not in hashes:
                        if len(hashes) > 500_000:
                            hashes.clear()
                        hashes[w] = word_hash(w)
                code = np.fromiter([hashes[w] if w in hashes else word_hash(w) for w in seen], np.int64, len(seen))
                n = np.fromiter(seen.values(), np.int64, len(seen))
                row = frequent.find(code)
                hit = row >= 0
                n_tokens.append(int(n.sum()) + 1)
                known.append(int(n[hit].sum()) + (ends > 0))
                base.append(float((n[hit] * weight[row[hit]]).sum()) + end)
                rare.append(code[~hit])
                rare_n.append(n[~hit])
            if whole_trie:
                logs = np.concatenate([model.score(part) for part in by_bytes(texts, len)] or [np.zeros(0)])
                far, far_n = [np.zeros(0, np.int64)] * len(texts), [np.zeros(0, np.int64)] * len(texts)
            else:
                parts = [_near_score(near, near_value, t, depth) for t in texts]
                logs, far, far_n = np.array([p[0] for p in parts]), [p[1] for p in parts], [p[2] for p in parts]
            flat = lambda xs: pa.ListArray.from_arrays(
                pa.array(np.cumsum([0] + [len(x) for x in xs]).astype(np.int32)),
                pa.array(np.concatenate(xs) if xs else np.zeros(0, np.int64)))
            size = np.array([len(t) + 1 for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(1)], *batch.columns[2:], pa.array(n_tokens, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(logs),
                 pa.array(size, pa.int64()), flat(rare), flat(rare_n), flat(far), flat(far_n)],
                names=["doc_id", "held_out", "doc_key", "n_tokens", "n_known", "base_score", "logs",
                       "size", "rare", "rare_n", "far", "far_n"])

    out = schema("doc_id long, held_out boolean, doc_key long, n_tokens long, n_known long, base_score double, "
                 "logs double, size long, rare array<long>, rare_n array<long>, far array<long>, far_n array<long>")
    held = F.col("held_out") if "held_out" in docs.columns else F.lit(None).cast("boolean")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text"),
                       held.alias("held_out"), F.monotonically_increasing_id().alias("doc_key"))
    scored = stored(rows.mapInArrow(run, out), "lm-scored")
    rare = scored.select("doc_key", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
    rare = rare.select("doc_key", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("times"))
    found = (rare.join(trained.vocabulary, F.col("word") == F.col("code"), "left")
             .groupBy(F.col("doc_key").alias("_key"))
             .agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("_known"),
                  F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - whole)).alias("_base")))
    out = scored.drop("rare", "rare_n", "far", "far_n").join(found, F.col("doc_key") == F.col("_key"), "left")
    logs = F.col("logs")
    if not whole_trie:
        far = scored.select("doc_key", F.explode(F.arrays_zip("far", "far_n")).alias("g"))
        far = far.select("doc_key", F.col("g.far").alias("code"), F.col("g.far_n").alias("times"))
        values = gram_values(trained.grams, far.select("code").distinct(), trained.frozen, depth)
        sums = (far.join(values, "code").groupBy(F.col("doc_key").alias("_doc"))
                .agg(F.sum(F.col("times") * F.col("value")).alias("_logs")))
        out = out.join(sums, F.col("doc_key") == F.col("_doc"), "left")
        logs = logs + F.coalesce("_logs", F.lit(0.0))
    return (out.withColumn("logs", logs)
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
                    (F.col("logs") / math.log(10)).alias("score"),
                    (-F.col("logs") / math.log(2) / F.col("size")).alias("bits_per_byte")))
