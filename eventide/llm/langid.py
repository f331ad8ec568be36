"""Language identification by prediction by partial matching.

For every language a byte-context tree of depth 2 is counted over its training texts (a Spark
aggregation of (language, context, symbol) counts).  The statistics are then frozen, and a
text's exact code length under each language's tree, with escapes and exclusions, decides: the
prediction is the language of the largest posterior, and ``score`` is that posterior.

Size: the counts of a language are at most 2**24 cells by construction, whatever the corpus,
and its scoring table at most 64 MiB; both are broadcast.

Letters are compared in lower case.  Defined results: a null text, or one without any letter,
is ``und`` with score 0; so is every text when there is nothing to learn from; training rows
with a null text or language are left out; equal posteriors go to the first language in code
point order; repeated rows count as often as they occur; further columns are passed on.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm import ppm
from eventide.llm.common import by_bytes, schema, small_batches

DEPTH = 2
LETTER = re.compile(r"[^\W\d_]")


def _count(batches):
    found = {}

    def flush(lang):
        texts, _ = waiting.pop(lang)
        parts = found.setdefault(lang, [])
        parts.append(ppm.count_grams(texts, DEPTH))
        if len(parts) > 16:
            found[lang] = [ppm.merge_counts(parts)]

    waiting = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts, size = waiting.get(lang, ([], 0))
            data = text.lower().encode()
            texts.append(data)
            waiting[lang] = (texts, size + len(data))
            if size + len(data) > 2 << 20:
                flush(lang)
    for lang in list(waiting):
        flush(lang)
    for lang, parts in found.items():
        code, n = ppm.merge_counts(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code, pa.int64()),
                                          pa.array(n, pa.int64())], names=["lang", "code", "n"])


class Frozen:
    """The languages, their share of the training texts, and their scoring tables."""

    def __init__(self, langs: list[str], prior: np.ndarray, tables: list):
        self.langs, self.prior, self.tables = langs, prior, tables


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Frozen:
    """Learn from the rows of ``docs`` that have both a language and a text."""
    small_batches(docs.sparkSession)
    train = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = (train.mapInArrow(_count, schema("lang string, code long, n long"))
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts["lang"].unique())
    tables, ends = [], []
    for x in langs:
        own = counts[counts["lang"] == x].sort_values("code")
        code, n = own["code"].to_numpy(), own["n"].to_numpy()
        ends.append(n[(code & 255) == ppm.END].sum())          # one end mark a text
        tables.append(ppm.dense(ppm.Model(code, n, DEPTH)))
    prior = np.log(np.array(ends, float) / sum(ends)) if langs else np.zeros(0)
    return Frozen(langs, prior, tables)


def predict(docs: DataFrame, model: Frozen, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``code_bits`` (the chosen code length)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "code_bits")]
    docs_kept = docs.select(*kept)
    at = kept.index(text)

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            pred, score, bits = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            todo = [(i, t.lower().encode()) for i, t in enumerate(texts) if t and m.langs and LETTER.search(t)]
            for part in by_bytes(todo, lambda x: len(x[1])):
                logs = ppm.dense_score(m.tables, [t for _, t in part])
                post = logs + m.prior
                best = post.argmax(axis=1)
                for j, (i, _) in enumerate(part):
                    b = best[j]
                    pred[i] = m.langs[b]
                    score[i] = 1.0 / np.exp(post[j] - post[j, b]).sum()
                    bits[i] = -logs[j, b] / np.log(2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(bits)],
                names=[*batch.schema.names, "lang_pred", "score", "code_bits"])

    more = schema("lang_pred string, score double, code_bits double")
    return docs_kept.mapInArrow(run, T.StructType([*docs_kept.schema.fields, *more.fields]))
