"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import bpe, decontaminate, embedding_dedup, html_extract, jaccard_join, lm_score, quality, secrets, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_bpe": bpe.op2_bpe,
        "op3_html_extraction": html_extract.op3_html_extraction,
        "op4_warc": warc.op4_warc,
        "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_quality": quality.op7_quality,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_lm_score": lm_score.op9_lm_score,
        "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": warc.OP4_SQL,
        "op8_decontamination": decontaminate.OP8_SQL,
        "op9_lm_score": lm_score.OP9_SQL,
        "op10_jaccard_join": jaccard_join.OP10_SQL,
    }
