"""The corpus operators as registered queries, each over its whole table, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kontora.llm import fingerprints, html_text, licences, line_runs, mixing, near_dups, periodic, pieces, quality, token_counts, toxicity, warc, whitening
from kontora.llm.common import documents


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": lambda s, f: token_counts.report(documents(s, f)),
        "op2_quality_rules": lambda s, f: quality.report(documents(s, f)),
        "op3_sentencepiece_dropout": lambda s, f: pieces.report(documents(s, f)),
        "op4_line_dedup": lambda s, f: line_runs.report(documents(s, f)).drop("runs"),
        "op5_document_fingerprints": lambda s, f: fingerprints.report(documents(s, f)),
        "op6_source_mixing": lambda s, f: mixing.report(documents(s, f)),
        "op7_license_scan": lambda s, f: licences.report(documents(s, f)),
        "op8_near_duplicates": lambda s, f: near_dups.report(documents(s, f), width=2),
        "op9_html_extraction": lambda s, f: html_text.report(s.read.parquet(f"{f}/pages.parquet")),
        "op10_toxicity": lambda s, f: toxicity.report(documents(s, f), labels(s, f)),
        "op11_embedding_whitening": lambda s, f: whitening.report(s.read.parquet(f"{f}/embeddings.parquet")),
        "op12_warc_archives": lambda s, f: warc.report(s.read.parquet(f"{f}/pages.parquet")).drop("record_id"),
        "op13_periodic_runs": lambda s, f: periodic.report(documents(s, f)),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality.SQL, "op4_line_dedup": line_runs.SQL, "op12_warc_archives": warc.SQL}
