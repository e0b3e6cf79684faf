"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import (
    bpe,
    decontamination,
    html_extract,
    lexical_search,
    line_dedup,
    near_dedup,
    neighbours,
    quality,
    secret_scan,
    sharding,
    suffix_dedup,
    token_counts,
    whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_near_dedup": near_dedup.op2_near_dedup,
        "op3_quality": quality.op3_quality,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_neighbours": neighbours.op5_neighbours,
        "op6_html_extraction": html_extract.op6_html_extraction,
        "op7_bpe": bpe.op7_bpe,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_sharding": sharding.op9_sharding,
        "op10_decontamination": decontamination.op10_decontamination,
        "op11_lexical_search": lexical_search.op11_lexical_search,
        "op12_whitening": whitening.op12_whitening,
        "op13_secret_scan": secret_scan.op13_secret_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE,
        "op2_near_dedup": near_dedup.ORACLE,
        "op4_suffix_dedup": suffix_dedup.ORACLE,
        "op9_sharding": sharding.ORACLE,
        "op10_decontamination": decontamination.ORACLE,
        "op11_lexical_search": lexical_search.ORACLE,
        "op13_secret_scan": secret_scan.ORACLE,
    }
