"""Document quality from the text and from its site, by hierarchical empirical Bayes.

A logistic regression on shape and word features of the text gives each document's evidence:
its log odds of being good, over the base rate.

Word features: the distinct words of each whole text are hashed into ``BINS`` bins.  Of the
labelled documents of each kind (good, bad, toxic) the number that hold a bin is counted; a bin's
log ratio is that of its smoothed shares among bad (or toxic) and good documents.  A document has
the sum (over the root of their number) and the largest of its bins' ratios, for bad and for
toxic.  A labelled document is left out of the counts by which it is itself rated.

Sites are judged by the outcomes of their documents
(the label where there is one, else the classifier's probability) at three levels: all, host,
and path of a host.  Each level is shrunk toward the one above,

    host = (sum_h + k_host * global) / (n_h + k_host)
    path = (sum_p - own + k_path * host) / (n_p - 1 + k_path)

where the strengths k come from the spread between sites (method of moments on grouped sums),
so a site with few documents stays near its parent.  A document's own outcome is left out of
its path.  The posterior is sigmoid(logit(path) + evidence).

Sites are counted by aggregates with map-side partial sums, and each level's spread is one row
of sums.  The regression is Spark ML's, over all labelled rows.  Bins are summed inside each task
first.  While the labelled ids are few (counted), the labels are sent to the texts, which are rated
where they lie; else labelled texts are moved once, and the features of every own kind after them.
Features are written by the tasks that made them, and sites by no more tasks than there are cores:
each file costs its executor a few processes (chmod), whatever its size.

Defined results: a null text counts as empty, with zero features; a null host or path is a site
of its own; with labels of one kind only the evidence is 0; without labels every outcome is the
base rate 1/2; several labels of one id count as their lowest, and as toxic if one is; without toxic labels the
toxic features are 0; repeated rows are documents of
their own; further columns are ignored.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import schema, small_batches, stored, words

SHAPES = ("symbols", "upper", "digits", "bars", "word_length", "same_as_last", "new_words", "log_words")
WORDS = ("bad_sum", "bad_most", "toxic_sum", "toxic_most")
FEATURES = SHAPES + WORDS
KINDS = ("none", "good", "bad", "toxic")        # a document's own label
BINS = 1 << 17
SHIPPED_IDS = 1 << 21           # labelled ids sent to every executor
LEAST, MOST = 1.0, 1e6          # bounds of a strength


def features(text: Column) -> dict[str, Column]:
    """Shape of a text (``SHAPES``); needs the word array as column ``_w``."""
    n = F.greatest(F.length(text), F.lit(1))
    w, n_words = F.col("_w"), F.greatest(F.size("_w"), F.lit(1))
    share = lambda keep: F.length(F.regexp_replace(text, f"[^{keep}]+", "")) / n
    same = F.size(F.filter(F.zip_with(w, F.slice(w, 2, n_words), lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False))))
    return {"symbols": share("#*$%&<>!"), "upper": share(r"\p{Lu}"), "digits": share("0-9"), "bars": share("|"),
            "word_length": F.least(F.length(F.array_join(w, "")) / n_words, F.lit(50.0)) / 10,
            "same_as_last": same / n_words, "new_words": F.size(F.array_distinct(w)) / n_words,
            "log_words": F.log1p(F.size("_w"))}


def bins(text: str | None) -> np.ndarray:
    """Distinct bins of the words of a text."""
    found = {crc32(w) % BINS for w in set((text or "").encode().split())}
    return np.fromiter(found, np.int64, len(found))


def _held(batches):
    """Rows (bin, good, bad, toxic): documents of each kind that hold the bin, summed over the task."""
    n = np.zeros((3, BINS + 1), np.int64)       # the last cell counts the documents
    for batch in batches:
        for text, good, toxic in zip(*(batch.column(k).to_pylist() for k in range(3))):
            at = np.append(bins(text), BINS)
            n[0 if good else 1, at] += 1
            if toxic and not good:
                n[2, at] += 1
    at = np.flatnonzero(n.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(x[at]) for x in n]], names=["bin", "good", "bad", "toxic"])


def word_ratios(seen: DataFrame) -> np.ndarray:
    """Log ratios by contrast (bad, toxic), own kind (``KINDS``) and bin.  ``seen``: (text, label, toxic)."""
    small_batches(seen.sparkSession)
    rows = (seen.where("label IS NOT NULL").select("text", F.expr("label = 1").alias("good"), "toxic")
            .mapInArrow(_held, schema("bin long, good long, bad long, toxic long"))
            .groupBy("bin").agg(*[F.sum(c).alias(c) for c in KINDS[1:]]).toArrow())
    n = np.zeros((3, BINS + 1))
    n[:, rows["bin"].to_numpy()] = [rows[c].to_numpy() for c in KINDS[1:]]
    out = np.zeros((2, len(KINDS), BINS), np.float32)
    for contrast, against, own in ((0, n[1], ("bad", "toxic")), (1, n[2], ("toxic",))):
        if not against[BINS] or not n[0][BINS]:
            continue
        for k, kind in enumerate(KINDS):
            a, g = np.maximum(against - (kind in own), 0), np.maximum(n[0] - (kind == "good"), 0)
            out[contrast, k] = np.log((a[:BINS] + .5) / (a[BINS] + 1)) - np.log((g[:BINS] + .5) / (g[BINS] + 1))
    return out


def _word_features(batches, ratios, known):
    """The rows with the word features for each own kind in place of the text (the last column).

    ``known``: the place of its own kind stands before the text; the features are of that kind alone.
    """
    names = WORDS if known else [f"{w}_{k}" for k in KINDS for w in WORDS]
    for batch in batches:
        made = np.zeros((len(names), batch.num_rows))
        *columns, texts = batch.columns
        own = [slice(k, k + 1) for k in columns.pop().to_pylist()] if known else [slice(None)] * batch.num_rows
        for row, text in enumerate(texts.to_pylist()):
            at = bins(text)
            if len(at):
                r = ratios[:, own[row]][:, :, at].astype(np.float64)
                both = np.stack([r.sum(axis=2) / math.sqrt(len(at) + 1), r.max(axis=2)], axis=1)
                made[:, row] = both.transpose(2, 0, 1).ravel()      # own kind, contrast, sum or most
        yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x) for x in made]],
                                         names=[*batch.schema.names[:len(columns)], *names])


def strength(sites: DataFrame, parent: Column) -> float:
    """Prior strength of a level from its spread: columns n, total, squares; ``parent`` mean."""
    mean = F.col("total") / F.col("n")
    r = sites.select("n", F.pow(mean - parent, 2).alias("d"), "squares", "total", mean.alias("m"), parent.alias("p")).agg(
        F.count("*").alias("sites"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("d")).alias("between"),
        F.sum(F.col("squares") - F.col("n") * F.col("m") * F.col("m")).alias("within"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("n") * F.col("p")).alias("p")).first()
    if not r["sites"] or r["n"] <= r["sites"] or r["sites"] < 2:
        return MOST
    noise = max(r["within"], 0.0) / (r["n"] - r["sites"])
    spread = (r["between"] - (r["sites"] - 1) * noise) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    p = min(max(r["p"] / r["n"], 1e-6), 1 - 1e-6)
    return min(max(p * (1 - p) / spread - 1, LEAST), MOST) if spread > 0 else MOST


def rate(docs: DataFrame, labels: DataFrame, host: Column, path: Column, shipped_ids: int = SHIPPED_IDS) -> DataFrame:
    """doc_id, host, path, evidence, host_posterior, path_posterior, score, kept.

    ``labels``: (doc_id, good), 1 or 0; a column toxic, 1 or 0, says which of the bad are toxic.
    """
    mark = F.max(F.coalesce(F.col("toxic"), F.lit(0)) > 0) if "toxic" in labels.columns else F.lit(False)
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.col("good").cast("double")).alias("label"), mark.alias("toxic"))
    # the count of ids decides whether the texts stay in place
    few = marks.limit(shipped_ids + 1).count() <= shipped_ids
    sent, at = F.broadcast(marks) if few else marks, F.col("doc_id") == F.col("_id")
    ratios = word_ratios(docs.select("doc_id", "text").join(sent, at))
    own = F.when(F.col("label").isNull(), 0).when(F.col("label") == 1, 1).when(F.col("toxic"), 3).otherwise(2)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    if few:
        rows = rows.join(sent, at, "left").withColumn("_own", own)
    shaped = rows.withColumn("_w", words(F.col("text"))).select(
        "doc_id", "host", "path", *(["label"] if few else []),
        *[c.cast("double").alias(k) for k, c in features(F.col("text")).items()], *(["_own"] if few else []), "text")
    made = WORDS if few else [f"{w}_{k}" for k in KINDS for w in WORDS]
    rows = shaped.mapInArrow(lambda it: _word_features(it, ratios, few), T.StructType(
        shaped.schema.fields[:-2 if few else -1] + [T.StructField(w, T.DoubleType()) for w in made]))
    if not few:
        # joined once: the features of all own kinds are shuffled, those of a document's own are stored
        rows = rows.join(sent, at, "left").withColumn("_own", own).select("doc_id", "host", "path", "label", *SHAPES, *[
            F.coalesce(*[F.when(F.col("_own") == k, F.col(f"{w}_{kind}")) for k, kind in enumerate(KINDS)]).alias(w) for w in WORDS])
    rows = stored(rows, "shapes")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows)
    seen = rows.where("label IS NOT NULL")
    kinds = {r["label"]: r["n"] for r in seen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    base = kinds.get(1.0, 0) / sum(kinds.values()) if kinds else 0.5
    odds = math.log(base / (1 - base)) if 0 < base < 1 else 0.0
    if len(kinds) == 2:
        fitted = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4, maxIter=50).fit(seen)
        logit = F.lit(float(fitted.intercept))
        for name, weight in zip(FEATURES, fitted.coefficients):
            logit = logit + F.col(name) * float(weight)
    else:
        logit = F.lit(odds)
    evidence = F.greatest(F.least(logit - odds, F.lit(30.0)), F.lit(-30.0))
    outcome = F.coalesce(F.col("label"), 1 / (1 + F.exp(-(evidence + odds))))
    rows = stored(rows.withColumn("evidence", evidence).withColumn("outcome", outcome)
                  .select("doc_id", "host", "path", "evidence", "outcome"), "evidence")

    def sums(*by):
        return rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("outcome").alias("total"),
                                     F.sum(F.col("outcome") * F.col("outcome")).alias("squares"))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    paths = stored(sums("host", "path").coalesce(cores), "paths")
    hosts = stored(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).coalesce(cores), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("total").alias("t")).first()
    mean = whole["t"] / whole["n"] if whole["n"] else base
    k_host = strength(hosts, F.lit(mean))
    hosts = hosts.select(F.col("host").alias("_host"),
                         ((F.col("total") + k_host * mean) / (F.col("n") + k_host)).alias("host_posterior"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    k_path = strength(paths, F.col("host_posterior"))
    paths = paths.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "host_posterior", "n", "total")
    at = F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p"))
    post = (F.col("total") - F.col("outcome") + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    post = F.least(F.greatest(post, F.lit(1e-6)), F.lit(1 - 1e-6))
    out = rows.join(paths, at).withColumn("path_posterior", post)
    score = 1 / (1 + F.exp(-(F.log(F.col("path_posterior") / (1 - F.col("path_posterior"))) + F.col("evidence"))))
    return (out.withColumn("score", score).withColumn("kept", F.col("score") >= 0.5)
            .select("doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", "score", "kept"))
