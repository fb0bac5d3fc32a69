"""The corpus pipeline: five stages over the table of documents, each written as Parquet and read again by the next.

Language ID drops documents whose language it can't tell and fills in the language of those that have none; exact dedup keeps
one document of each group of equal texts and near dedup one of each component of linked texts; personal data is replaced by
marks; what is left is packed into sequences. All stages but the last return the columns of documents.

Defined results: a stage works on rows. Rows with a null doc_id, or that share one, are told apart by their texts; rows that
repeat both are one in the dedup stages. Null and empty texts, and texts without a letter, have no language and go in the first stage; texts of any length are read
whole; ties go to the smallest doc_id, a null one last; an empty table gives no rows in any stage; columns other than those of documents
are left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import dedup_exact, dedup_near, langid, packing, pii
from skylattice.llm._shared import delete, documents, new_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Tokenised by word_bpe_49k unless a caller says otherwise.
PACKING_VOCABULARY = "word_bpe_49k.json"

#: The packing stage encodes by a tokenizer, so no SQL gives run()'s rows.
ORACLE_SQL = None


def _unclear_ids(docs: DataFrame) -> DataFrame | None:
    """The doc_ids that several rows have, null among them; None if there are none. One shuffle of the ids alone."""
    unclear = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("unclear_id"))
    return None if unclear.isEmpty() else unclear


def _sha(text: Column) -> Column:
    return F.sha2(dedup_exact.normalised(text).cast("binary"), 256)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not told with a score of langid.LEAST_SCORE: null texts and texts without a letter among them."""
    return langid.recognised(docs.select(*COLUMNS), langid.fit(langid.training_rows(docs), langid.default_vocabulary()))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts one row: the longest one, then that with the smallest doc_id."""
    rows, kept = docs.select(*COLUMNS), dedup_exact.deduplicate(docs).where("kept")
    if _unclear_ids(docs) is None:
        return rows.join(kept.select("doc_id"), "doc_id", "left_semi").select(*COLUMNS)
    chosen = kept.select(F.col("doc_id").alias("chosen_id"), "text_sha256").distinct()
    rows = rows.withColumn("own_sha", _sha(F.col("text")))
    rows = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("own_sha") == F.col("text_sha256")), "left_semi")
    # rows that repeat a doc_id and an equal text: the longest text stays, then the first in order
    order = F.struct(F.char_length("text"), "text", "lang", "source", "n_chars")
    best = rows.groupBy("doc_id", "own_sha").agg(F.max(order).alias("best"))
    return best.select("doc_id", "best.text", "best.lang", "best.source", "best.n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near duplicates the document with the smallest doc_id; of rows without an id or that share one, any."""
    rows, unclear = docs.select(*COLUMNS), _unclear_ids(docs)
    if unclear is None:
        return rows.join(dedup_near.link(rows).where("kept").select("doc_id"), "doc_id", "left_semi").select(*COLUMNS)
    # such rows get numbers of their texts, above all ids
    rows = rows.join(unclear, F.col("doc_id").eqNullSafe(F.col("unclear_id")), "left_anti").withColumn("key", F.col("doc_id")).unionByName(
        rows.join(unclear, F.col("doc_id").eqNullSafe(F.col("unclear_id")), "left_semi").withColumn("key", F.xxhash64("doc_id", "text").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1)))
    )
    kept = dedup_near.link(rows, id_col="key").where("kept").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind; n_chars is that of the new text."""
    clean = pii.redacted(docs.select(*COLUMNS), pii.fit(spark))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(PACKING_VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's table is deleted when the next one's is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            delete(spark, before)
        before = folder
    return docs
