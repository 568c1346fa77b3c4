"""The operators' queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (
    clustering,
    decontamination,
    fingerprint,
    language,
    lm,
    minhash,
    mixing,
    oracle,
    phrases,
    quality,
    sharding,
    simhash,
    urlfilter,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_warc": warc.op2_warc,
        "op3_decontamination": decontamination.op3_decontamination,
        "op4_lm_scoring": lm.op4_lm_scoring,
        "op5_mixing": mixing.op5_mixing,
        "op6_quality": quality.op6_quality,
        "op7_sharding": sharding.op7_sharding,
        "op8_url_filters": urlfilter.op8_url_filters,
        "op9_fingerprints": fingerprint.op9_fingerprints,
        "op10_language": language.op10_language,
        "op11_clustering": clustering.op11_clustering,
        "op12_phrases": phrases.op12_phrases,
        "op13_minhash": minhash.op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLES)
