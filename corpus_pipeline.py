"""Training-data pipeline over the documents table.

Five stages, each one operator of ``eventide.llm``: reject texts without a language, keep one of
every group of near duplicates, replace personal data, mix the sources to their target weights,
and encode the result as pieces.  Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import langid, mixing, near_dedup, pii, sentencepiece
from eventide.llm.common import id_crc, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no language (``und``: null texts and texts without a letter)."""
    model = langid.fit(docs.where(id_crc(F.col("doc_id")) % 3 != 1))
    # without any labelled text there is nothing to go by: letters decide alone
    if not model.langs:
        return _columns(docs.where(F.regexp_like("text", F.lit(r"\p{L}"))))
    return _columns(langid.predict(docs, model).where("lang_pred != 'und'"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group stays: that of the smallest id (five-word shingles, 0.8)."""
    judged = near_dedup.near_duplicates(docs, size=5, percent=80)
    gone = judged.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return _columns(docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates; n_chars follows the text."""
    return _columns(pii.pseudonymise(docs).withColumn("n_chars", F.length("text").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, rounded to whole documents.

    A document without words has no part in a mix by words and goes.
    """
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-input")
    # repeated ids: every row is a document of its own, known by its row number
    taken = mixing.taken(keyed.select(F.col("_row").alias("doc_id"), "text", "source"))
    times = taken.select(F.col("doc_id").alias("_key"),
                         F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int").alias("_times"))
    rows = keyed.join(times.where("_times > 0"), F.col("_row") == F.col("_key"))
    return _columns(rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces, ids, n_chunks, round_trip."""
    return sentencepiece.encode(docs.select("doc_id", "lang", "source", "text")).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

# The learned, iterative and tokenizer stages have no SQL form; tests hold them against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
