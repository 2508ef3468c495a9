"""Queries over the driver's tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boutlake.llm import embedding_dedup, filter_audit, line_dedup, mixing, packing, quality_classifier, quality_rules, secret_scan, simhash, substring_dedup, token_files, toxicity, whitening
from boutlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: operator(*(table(spark, sf_dir, n) for n in names))


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": _over(toxicity.op1_toxicity, "documents", "labels"),
        "op2_substring_dedup": _over(substring_dedup.op2_substring_dedup, "documents"),
        "op3_secret_scan": _over(secret_scan.op3_secret_scan, "documents"),
        "op4_source_mixing": _over(mixing.op4_source_mixing, "documents"),
        "op5_quality_rules": _over(quality_rules.op5_quality_rules, "documents"),
        "op6_best_fit_packing": _over(packing.op6_best_fit_packing, "documents"),
        "op7_embedding_near_dedup": _over(embedding_dedup.op7_embedding_near_dedup, "embeddings"),
        "op8_line_dedup": _over(line_dedup.op8_line_dedup, "documents"),
        "op9_simhash_near_dedup": _over(simhash.op9_simhash_near_dedup, "documents"),
        "op10_quality_classifier": _over(quality_classifier.op10_quality_classifier, "documents", "labels"),
        "op11_token_files": _over(token_files.op11_token_files, "documents"),
        "op12_embedding_whitening": _over(whitening.op12_embedding_whitening, "embeddings"),
        "op13_filter_audit": _over(filter_audit.op13_filter_audit, "documents", "labels"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": substring_dedup.OP2_SQL,
        "op3_secret_scan": secret_scan.OP3_SQL,
        "op4_source_mixing": mixing.OP4_SQL,
        "op5_quality_rules": quality_rules.OP5_SQL,
        "op7_embedding_near_dedup": embedding_dedup.OP7_SQL,
        "op8_line_dedup": line_dedup.OP8_SQL,
        "op13_filter_audit": filter_audit.OP13_SQL,
    }
