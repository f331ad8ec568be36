"""Quality rules: hashed n-gram likelihood ratio of a trusted target against the raw corpus.

Words and pairs of neighbouring words are hashed into ``buckets`` bins.  Two multinomials are
counted, over all raw documents and over the trusted ones, each smoothed by one count a bin.
A document's rating is the mean over its n-grams of log(p_target / p_raw), so that it doesn't
depend on length.  Log ratios are rounded to millionths and summed as integers: the rating, and
so the verdict ``rating >= threshold``, is the same in any order of evaluation.

A toxic text is a clean one but for a few words, which a mean drowns.  So its ratio is of words
alone: the documents that hold a bin (``WORD_BUCKETS``) are counted among the toxic and among the
trusted, and a document's toxic rating is its largest log ratio, in thousandths.

Both cuts come from the ratings of all trusted documents: each refuses at most ``FALSE_REJECT`` of
them.  For this the labelled are rated crosswise, by counts of the other half of them, and counted
by cells of a ten-thousandth; the verdicts use the counts of all.

Everything is DataFrame expressions.  The model has ``buckets`` numbers at any corpus size and
is put into the plan as one constant array.  Counting explodes n-grams and sums them by bin
before any shuffle; rating a document needs no shuffle at all.  The trusted texts are found where
they lie while there are at most ``SHIPPED_IDS`` trusted ids (counted first); beyond that one
join shuffles each text once.  Both count the same texts.

Each word and each pair is hashed once: the bins of both ratings and the repeated windows (two
neighbouring pairs) are taken from these two arrays.

Words: runs of anything but ASCII blanks; n-grams keep case.  Base measures of each text:
word_chars, n_symbols, n_dup_lines, n_repeat_words.

Defined results: a null or empty text has no words, measures 0 and rating 0, and fails the base
rules; an unlabelled corpus has no target, every rating is that of a flat target, and no rating is
cut; without toxic labels there is no toxic cut; repeated
rows are rated alike; further columns are passed over.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import id_crc, let, literal_array, stored, words

BUCKETS = 1 << 14
SCALE = 1_000_000
SHIPPED_IDS = 1 << 21           # trusted ids (about 100 MB as a hash table) sent to every executor
WORD_BUCKETS = 1 << 16
FALSE_REJECT = 0.02             # share of the trusted that a cut may refuse
CELLS = 10_000                  # cells of a rating, for the cuts
SYMBOLS = r"[^#*$%&|<>]+"


def word_chars(w: Column) -> Column:
    """Code points of the words of a word array."""
    return F.length(F.array_join(w, "")).cast("long")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
               lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def hashed(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with _w (its words), _one (the hash of each) and _two (of each pair of neighbours)."""
    pairs = F.greatest(F.size("_w") - 1, F.lit(0))
    return (docs.withColumn("_w", words(F.col("text"))).withColumn("_one", F.transform("_w", lambda x: F.xxhash64(x)))
            .withColumn("_two", F.zip_with(F.slice("_w", 1, pairs), F.slice("_w", 2, pairs), lambda a, b: F.xxhash64(a, b))))


def window_hashes(w: Column, size: int = 3) -> Column:
    """Hash of each window of words (or, with 2, of pairs: the same windows as 3 of words)."""
    at = lambda i, k: F.get(w, i + k)
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[at(i, k) for k in range(1, size)]))


def windows(hashes: Column) -> Column:
    """Sorted (hash, position) of the word windows; null if all hashes differ."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                  F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))


def covered(sorted_windows: str, size: int = 3) -> Column:
    """Words that lie in a window which occurs twice or more (null: none does)."""
    s = F.col(sorted_windows)
    twice = F.filter(s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    gaps = lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                lambda a, b: F.least(F.coalesce(b - a, F.lit(size)), F.lit(size)))
    words_in = let(places, lambda p: F.aggregate(gaps(p), F.lit(0), lambda acc, x: acc + x))
    return F.when(s.isNull(), F.lit(0)).otherwise(words_in).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the columns of ``hashed``, n_words and the base measures."""
    docs = hashed(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    docs = docs.withColumn("_h", window_hashes(F.col("_two"), 2)).withColumn("_s", windows(F.col("_h")))
    return (docs.withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", word_chars(F.col("_w")))
            .withColumn("n_symbols", F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long"))
            .withColumn("n_dup_lines", dup_lines(F.col("text")))
            .withColumn("n_repeat_words", covered("_s")).drop("_s", "_h"))


def bin_of(h: Column, buckets: int) -> Column:
    """Remainder of a hash."""
    return h.bitwiseAND(buckets - 1) if buckets & (buckets - 1) == 0 else F.pmod(h, F.lit(buckets))


def bins(word: Column, following: Column, buckets: int) -> tuple[Column, Column]:
    """Bins of a word, and of the pair it begins (null at the last word)."""
    return (bin_of(F.xxhash64(word), buckets),
            F.when(following.isNotNull(), bin_of(F.xxhash64(word, following), buckets)))


def bin_counts(docs: DataFrame, buckets: int, *by: str) -> DataFrame:
    """(by, bin, n): n-grams of all texts by bin."""
    pairs = docs.select(*by, words(F.col("text")).alias("w")).select(
        *by, F.inline(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))))
    one, two = bins(F.col("a"), F.col("b"), buckets)
    rows = pairs.select(*by, one.alias("one"), two.alias("two")).select(*by, F.expr("stack(2, one, two)").alias("bin"))
    return rows.where("bin IS NOT NULL").groupBy(*by, "bin").agg(F.count("*").alias("n"))


def word_counts(docs: DataFrame, buckets: int, *by: str) -> DataFrame:
    """(by, bin, n): texts that hold a word of the bin."""
    held = F.array_distinct(F.transform(words(F.col("text")), lambda x: bin_of(F.xxhash64(x), buckets)))
    return docs.select(*by, F.explode(held).alias("bin")).groupBy(*by, "bin").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Log ratio of each bin in millionths.  ``trusted``: (doc_id) of the target documents."""
    docs = docs.select("doc_id", "text").where("text IS NOT NULL")
    ids = trusted.select("doc_id").distinct()
    # the count of ids, not the planner's guess of their size, decides whether the texts stay in place
    few = ids.limit(SHIPPED_IDS + 1).count() <= SHIPPED_IDS
    target = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    raw, good = bin_counts(docs, buckets), bin_counts(target, buckets)
    spark = docs.sparkSession
    both = (spark.range(buckets).withColumnRenamed("id", "bin")
            .join(raw.withColumnRenamed("n", "r"), "bin", "left").join(good.withColumnRenamed("n", "t"), "bin", "left")
            .select("bin", *[(F.coalesce(c, F.lit(0)) + 1).cast("double").alias(c) for c in "rt"]))
    sums = both.agg(F.sum("r").alias("sr"), F.sum("t").alias("st"))
    ratio = F.round(SCALE * (F.log(F.col("t") / F.col("st")) - F.log(F.col("r") / F.col("sr")))).cast("long")
    # ``sums`` is one row
    rows = both.join(F.broadcast(sums)).select("bin", ratio.alias("x")).collect()
    return [r["x"] for r in sorted(rows)]


def rating(one: Column, two: Column, ratios: list[int]) -> Column:
    """Mean log ratio over n-grams, by the hashes of words and of pairs (0 without words)."""
    table = literal_array(ratios, "bigint")

    def total(hashes):
        return F.aggregate(hashes, F.lit(0).cast("bigint"),
                           lambda acc, h: acc + table[bin_of(h, len(ratios))])
    sums = total(one) + total(two)
    return F.when(F.size(one) > 0, sums / (2.0 * F.size(one) - 1) / SCALE).otherwise(0.0)


def toxic_rating(one: Column, ratios: list[int]) -> Column:
    """Largest log ratio of words, by their hashes (0 without words)."""
    table = literal_array(ratios, "int")
    return F.coalesce(F.array_max(F.transform(one, lambda h: table[bin_of(h, len(ratios))])) / 1000.0, F.lit(0.0))


class Model(NamedTuple):
    ratios: list[int]
    threshold: float            # of the rating
    toxic: list[int]
    toxic_cut: float            # the toxic rating must be below
    rates: dict                 # crosswise: share refused by either cut, (trusted, toxic)


def _cut(cells: dict[int, int], share: float) -> int | None:
    """Largest cell with at most ``share`` of the rows below it."""
    left = share * sum(cells.values())
    for cell in sorted(cells):
        left -= cells[cell]
        if left < 0:
            return cell
    return None


def learn(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, word_buckets: int = WORD_BUCKETS,
          false_reject: float = FALSE_REJECT) -> Model:
    """Ratios and cuts from all of ``docs`` and all of ``labels`` (doc_id, quality, toxic)."""
    docs = docs.select("doc_id", "text").where("text IS NOT NULL")
    toxic = F.max(F.coalesce(F.col("toxic"), F.lit(0)) > 0)
    marks = (labels.groupBy(F.col("doc_id").alias("_id")).agg(toxic.alias("is_toxic"), F.max("quality").alias("_q"))
             .where("is_toxic OR _q = 1").select("_id", "is_toxic"))
    few = marks.limit(SHIPPED_IDS + 1).count() <= SHIPPED_IDS
    seen = (docs.join(F.broadcast(marks) if few else marks, F.col("doc_id") == F.col("_id"))
            .withColumn("fold", (id_crc(F.col("doc_id")) % 2).cast("int")))
    if not few:             # several passes follow: the texts move once
        seen = stored(seen, "labelled")

    def arrays(counts, size, *by):
        got = counts.toArrow()
        out = np.zeros((*[2] * len(by), size))
        out[tuple(got[c].to_numpy().astype(np.int64) for c in (*by, "bin"))] = got["n"].to_numpy()
        return out
    raw = arrays(bin_counts(docs, buckets), buckets)
    good = arrays(bin_counts(seen.where("NOT is_toxic"), buckets, "fold"), buckets, "fold")
    held = arrays(word_counts(seen.withColumn("kind", F.col("is_toxic").cast("int")), word_buckets, "fold", "kind"),
                  word_buckets, "fold", "kind")
    sizes = np.zeros((2, 2))
    for r in seen.groupBy("fold", "is_toxic").agg(F.count("*").alias("n")).collect():
        sizes[r["fold"], int(r["is_toxic"])] = r["n"]

    def ratio(t, r):
        t, r = t + 1, r + 1
        return [int(x) for x in np.rint(SCALE * (np.log(t / t.sum()) - np.log(r / r.sum())))]

    def word_ratio(n, size):
        share = lambda k: np.log((n[k] + 0.5) / (size[k] + 1))
        return [int(x) for x in np.rint(1000 * (share(1) - share(0)))]
    ratios, words_of = ratio(good.sum(axis=0), raw), word_ratio(held.sum(axis=0), sizes.sum(axis=0))
    one, two, first = F.col("_one"), F.col("_two"), F.col("fold") == 0
    crossed = hashed(seen).select("is_toxic", *[
        F.floor(CELLS * F.when(first, by(1)).otherwise(by(0))).alias(name) for name, by in (
            ("a", lambda k: rating(one, two, ratio(good[k], raw))),
            ("b", lambda k: toxic_rating(one, word_ratio(held[k], sizes[k]))))])
    crossed = crossed.select("is_toxic", F.expr("stack(2, 0, a, 1, -b)").alias("what", "cell"))
    cells = {(k, t): {} for k in (0, 1) for t in (False, True)}
    for r in crossed.groupBy("is_toxic", "what", "cell").agg(F.count("*").alias("n")).collect():
        cells[r["what"], r["is_toxic"]][r["cell"]] = r["n"]
    cuts = [_cut(cells[k, False], false_reject) for k in (0, 1)]
    if not sizes[:, 1].sum():
        cuts[1] = None
    rates = {("rating", "toxic rating")[k]: tuple(
        sum(n for c, n in cells[k, t].items() if c < cut) / max(sum(cells[k, t].values()), 1) for t in (False, True))
        for k, cut in enumerate(cuts) if cut is not None}
    # cells of the toxic rating run downwards: refused is what lies above the cell -cut
    return Model(ratios, -math.inf if cuts[0] is None else cuts[0] / CELLS, words_of,
                 math.inf if cuts[1] is None else (1 - cuts[1]) / CELLS, rates)


def judge(docs: DataFrame, ratios: list[int], threshold: float = 0.0, toxic: list[int] | None = None,
          toxic_cut: float = math.inf) -> DataFrame:
    """doc_id, n_words, base measures, base_failed, kept, rating, and with ``toxic`` toxic_rating."""
    rated = measures(docs.select("doc_id", "text")).withColumn(
        "rating", rating(F.col("_one"), F.col("_two"), ratios))
    clean = F.lit(True)
    if toxic is not None:
        rated = rated.withColumn("toxic_rating", toxic_rating(F.col("_one"), toxic))
        clean = F.col("toxic_rating") < toxic_cut
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rated.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("rating") >= threshold) & clean)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "rating", *(["toxic_rating"] if toxic is not None else [])))
