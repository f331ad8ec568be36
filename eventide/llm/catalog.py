"""Queries of the text operators, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.llm import (conversations, fingerprints, langid, line_dedup, lm, mixing, near_dedup, phrases,
                          pii, quality_rules, repeated_lines, sentencepiece, site_quality)
from eventide.llm.common import id_crc, table


def op1_likelihood_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))
    return quality_rules.judge(docs, model.ratios, model.threshold, model.toxic, model.toxic_cut)


def op2_surrogates(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeats(docs)


def op4_lz_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_ppm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc(F.col("doc_id")) % 7 == 2)
    return lm.score(docs, lm.fit(docs.where(~F.col("held_out"))))


def op6_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op7_site_quality(spark, sf_dir):
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", good.cast("int").alias("good"), "toxic")
    # the host is the document's source, its sections are the languages
    return site_quality.rate(table(spark, sf_dir, "documents"), labels, F.col("source"), F.col("lang"))


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc(F.col("doc_id")) % 3 == 1)
    model = langid.fit(docs.where(~F.col("held_out")))
    return (langid.predict(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score", "code_bits"))


def op9_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode(docs).drop("text")


def op10_mix_sources(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_conversations(spark, sf_dir):
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    fixed = conversations.repair(rows, F.col("gone"))
    shown = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return fixed.withColumn("repaired_sha256", F.sha2(F.array_join(shown, "\n"), 256)).drop("repaired")


def op12_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_common_lines(spark, sf_dir):
    docs = repeated_lines.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_likelihood_rules, op2_surrogates, op3_line_dedup, op4_lz_fingerprints, op5_ppm_scores, op6_near_duplicates,
    op7_site_quality, op8_language_id, op9_pieces, op10_mix_sources,
    op11_conversations, op12_collocations, op13_common_lines, pipeline)}

SQL: dict[str, str] = {
    "op11_conversations": conversations.REPAIR_SQL,
    "op12_collocations": phrases.PHRASE_SQL,
    "op13_common_lines": repeated_lines.LINE_SQL,
}
