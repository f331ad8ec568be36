"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of ``block`` words.  Slot ``n`` is given the point
frac(n * golden ratio); the cumulative target shares map the point to a source, so every
stretch of the sequence holds the sources in nearly their target proportions.  The slots of
a source are ranked, and slot ``k`` of a source takes the ``k``-th block of equal size from
the source's documents, laid end to end in a keyed shuffled order and repeated (at most
``max_epochs`` times).

Targets: every source has a weight; all words are shared out by weight; a source's target
stops at ``max_epochs`` times its size and the excess is shared again by weight.

Skew: the words before a document in its source, and the rank of a slot, are two-level
prefix sums over fixed-size buckets (of the shuffle hash, of the slot number), so no source
ever has to fit in one task.  Only one row per source goes through a single task.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of
its own, last in order; repeated rows count as separate documents; an empty table gives an
empty mix; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventide.llm.common import prefix_sums, stored, words

GOLDEN = 1327217885             # 2**31 / golden ratio, odd: n -> n * GOLDEN mod 2**31 is a bijection
SPREAD = 1024                   # hash buckets for a source's document order
RUN = 1 << 14                   # slots ranked together
CELLS = 4096                    # cells of the unit interval for slot -> source


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each whole text."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))


def by_position(weights: tuple[int, ...] = (1, 2, 3)):
    """Weights repeated along the sources in code point order, null last."""
    def weigh(source: Column) -> Column:
        at = F.row_number().over(W.orderBy(source.asc_nulls_last())) - 1
        return F.get(F.array(*[F.lit(float(w)) for w in weights]), at % len(weights))
    return weigh


def targets(sized: DataFrame, weigh=by_position(), max_epochs: int = 3) -> DataFrame:
    """One row per source: source, source_size, weight, target, share_from, share_to.

    target = min(max_epochs * size, level * weight), with the one level at which the targets
    sum to all words.  Sorted by cap / weight, the capped sources are a prefix, so the level
    follows from running sums.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("weight", weigh(F.col("source")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    order = W.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    per = (per.withColumn("_all", F.sum("source_size").over(every).cast("double"))
           .withColumn("_capped", F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)))
           .withColumn("_rest", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))))
    level = (F.col("_all") - F.coalesce(F.col("_capped"), F.lit(0.0))) / F.col("_rest")
    # the first source that its cap does not bind sets the level
    per = per.withColumn("_level", F.when(level * F.col("weight") <= F.col("_cap"), level))
    per = per.withColumn("_level", F.first("_level", ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    per = per.withColumn("target", F.least(F.col("_cap"), F.coalesce(
        F.col("_level") * F.col("weight"), F.col("_cap"))))
    along = W.orderBy(F.col("source").asc_nulls_last())
    share = F.col("target") / F.col("_all")
    return (per.withColumn("share_to", F.sum(share).over(along.rowsBetween(W.unboundedPreceding, 0)))
            .withColumn("share_from", F.col("share_to") - share)
            .select("source", "source_size", "weight", "target", "share_from", "share_to"))


def slots(spark, plan: DataFrame, total: int, block: int) -> DataFrame:
    """(slot, source, rank, take): the schedule; ``take`` words of block ``rank`` of the source.

    One and a quarter rounds of points are dealt; a source takes no more once its target is
    reached.  A source whose points fall short of its target (a share of few points may hold
    none) gets the ranks it lacks as extra blocks, spread evenly over the schedule: such a slot
    holds blocks of several sources.
    """
    n = -(-total // block) * 5 // 4 + 64 if total else 0
    one = 1 << 31
    wrapped = (F.col("id") % one) * GOLDEN % one
    points = spark.range(n).select(F.col("id").alias("slot"), (wrapped / F.lit(float(one))).alias("point"))
    points = points.withColumn("_cell", F.floor(F.col("point") * CELLS))
    cells = plan.where("target > 0").select(
        "source", "target", "share_from", "share_to",
        F.explode(F.sequence(F.floor(F.col("share_from") * CELLS), F.floor(F.col("share_to") * CELLS))).alias("_cell"))
    dealt = (points.join(cells, "_cell")
             .where((F.col("point") >= F.col("share_from")) & (F.col("point") < F.col("share_to")))
             .select("slot", "source", "target", F.expr(f"slot div {RUN}").alias("_run"), F.lit(1).alias("_one")))
    ranked = prefix_sums(dealt, ["source"], "_run", [F.col("slot")], "_one", "rank")
    goal = F.round("target").cast("long")
    counts = dealt.groupBy(F.col("source").alias("_src")).agg(F.count("*").alias("_n"))
    short = (plan.where("target > 0").select("source", "target")
             .join(counts, F.col("source").eqNullSafe(F.col("_src")), "left")
             .withColumn("_n", F.coalesce("_n", F.lit(0)))
             .withColumn("_lack", F.ceil(goal / block) - F.col("_n")).where("_lack > 0"))
    # from a place of the source's own, in equal steps
    place = F.pmod(F.xxhash64("source"), F.lit(max(n, 1))) + F.floor(F.col("_i") * F.lit(n) / F.col("_lack"))
    extra = (short.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_lack") - 1)))
             .select((place % F.lit(max(n, 1))).cast("long").alias("slot"), "source", "target",
                     (F.col("_n") + F.col("_i")).alias("rank")))
    ranked = ranked.select("slot", "source", "target", F.col("rank").cast("long").alias("rank")).unionByName(extra)
    return (ranked.withColumn("take", F.least(F.lit(block).cast("long"), goal - F.col("rank") * block))
            .where("take > 0").select("slot", "source", "rank", "take"))


def mix(docs: DataFrame, block: int = 128, max_epochs: int = 3, seed: int = 7,
        weigh=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, targets, stream).

    documents: doc_id, source, size, doc_key; targets: see ``targets``; stream: one row per
    piece of a document in a slot: slot, source, doc_key, doc_id, epoch, from_word, n_words.
    """
    spark = docs.sparkSession
    sized = sizes(docs).withColumn("_h", F.xxhash64(F.lit(seed), "doc_id"))
    sized = stored(sized.withColumn("doc_key", F.monotonically_increasing_id()), "mix-sizes")
    plan = stored(targets(sized, weigh or by_position(), max_epochs), "mix-targets")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    sched = slots(spark, plan, total, block)
    laid = prefix_sums(sized.where("size > 0").withColumn("_bin", F.pmod("_h", F.lit(SPREAD))), ["source"],
                       "_bin", [F.col("_h"), F.col("doc_id"), F.col("size"), F.col("doc_key")], "size", "_off")
    goal = plan.select(F.col("source").alias("_src"), F.col("source_size").alias("_all"),
                       F.round("target").cast("long").alias("_goal"))
    laid = laid.join(goal, F.col("source").eqNullSafe(F.col("_src")))
    # the document's place in each pass over its source, cut to what the source takes
    laid = laid.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    laid = (laid.withColumn("_from", F.col("epoch") * F.col("_all") + F.col("_off"))
            .withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_goal"))).where("_to > _from"))
    pieces = laid.withColumn("_rank", F.explode(F.expr(
        f"sequence(_from div {block}, (_to - 1) div {block})")))
    pieces = pieces.select("source", "_rank", "doc_key", "doc_id", "epoch", "_from", "_to")
    at = sched.select(F.col("source").alias("_src"), F.col("rank").alias("_r"), "slot", "take")
    start = F.greatest("_from", F.col("_rank") * block)
    end = F.least("_to", F.col("_rank") * block + F.col("take"))
    stream = (pieces.join(at, (F.col("_rank") == F.col("_r")) & F.col("source").eqNullSafe(F.col("_src")))
              .withColumn("n_words", end - start).where("n_words > 0")
              .select("slot", "source", "doc_key", "doc_id", "epoch",
                      (start - F.col("_from")).alias("from_word"), "n_words"))
    return sized.drop("_h"), plan, stream


def taken(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized, plan, stream = mix(docs, **how)
    got = stream.groupBy(F.col("doc_key").alias("_key")).agg(F.sum("n_words").alias("taken"))
    plan = plan.select(F.col("source").alias("_src"), "source_size", "target")
    return (sized.join(got, F.col("doc_key") == F.col("_key"), "left")
            .join(plan, F.col("source").eqNullSafe(F.col("_src")), "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"))
