"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lidarframe.llm import (
    byte_bpe,
    clustering,
    language,
    mixing,
    packing,
    product_quantisation,
    quality,
    resampling,
    sharding,
    simhash,
    substrings,
    toxicity,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            sharding.op1_sharding,
            product_quantisation.op2_product_quantisation,
            toxicity.op3_toxicity,
            language.op4_language,
            packing.op5_best_fit_packing,
            substrings.op6_substring_dedup,
            warc.op7_warc,
            quality.op8_quality_rules,
            simhash.op9_simhash,
            mixing.op10_temperature_mixing,
            clustering.op11_eenns_clustering,
            byte_bpe.op12_byte_bpe,
            resampling.op13_importance_resampling,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_product_quantisation": product_quantisation.OP2_SQL,
        "op7_warc": warc.OP7_SQL,
        "op8_quality_rules": quality.OP8_SQL,
        "op11_eenns_clustering": clustering.OP11_SQL,
        "op13_importance_resampling": resampling.OP13_SQL,
    }
