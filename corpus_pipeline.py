"""From raw documents to packed training sequences, in stages that each write their result.

Every stage but the last takes and returns rows with the columns of documents: documents of low quality go;
lines that repeat, nearly, keep their first occurrence; of near-duplicate documents the one of the smallest
doc_id stays; documents with benchmark items go; and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm import decontam, linededup, minhash, packing, quality
from nearfield.llm.common import table
from nearfield.scratch import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A null text is scored as an empty one; rows of equal text are
    decided alike; an empty table stays empty."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no text is left go; n_chars follows the text. Null, empty and blank texts stay as they
    are; rows of equal doc_id and text are one document, and of equal lines the one of the smallest doc_id and
    place stays (null ids come last)."""
    out = linededup.documents_without_repeats(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        length = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
        out = out.withColumn("n_chars", length)
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document of the smallest doc_id stays, once if its row repeats. Texts without words are
    in no group; a row without doc_id stays only if its group has no other."""
    return minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go; null and empty texts hold none. Rows of equal doc_id and text are
    decided alike; an empty benchmark lets all pass."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null or empty text is the end id alone; rows that repeat are packed as often as they occur."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL has no compression, signatures, latent space or tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents: the pieces with their places in the sequences (see packing.pack)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
