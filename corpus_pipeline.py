"""Documents through the corpus operators, stage by stage, into packed training sequences.

Each stage takes what its predecessor kept, and its result is written as Parquet before the next
reads it. Repeated rows stay rows of their own until the near-duplicate stage leaves one of each group;
the mix may then repeat a document, and each repeat is packed. n_chars follows the text. Very long texts are
taken whole in every stage, an empty table passes through all of them, and columns beside those of documents
are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutlake.llm.common import held_out, materialize, table
from boutlake.llm.line_dedup import dedup_lines
from boutlake.llm.mixing import mixed_documents
from boutlake.llm.packing import pack_documents
from boutlake.llm.quality_classifier import GOOD_AT, fit_quality
from boutlake.llm.simhash import drop_near_duplicates

#: The classifier, the fingerprints and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labels of rows that are not held out.

    A null text is judged as an empty one; without labels every document scores 0.5 and stays.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return model.accepted(docs, GOOD_AT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated three-line passages.

    Null and empty texts stay as they are, and so do rows without doc_id.
    """
    return _counted(dedup_lines(docs, counts=False))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id.

    Null and empty texts have one fingerprint and are one group; a row without doc_id
    stays only where none of its group has one.
    """
    return drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; at most one a source is cut.

    Documents without words, null texts among them, have nothing to take; null sources are one source.
    """
    return _counted(mixed_documents(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences; a null or empty text would be the one piece of its end token."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
