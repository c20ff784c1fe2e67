"""The registered queries of this subpackage: one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, decontam, filter_audit, fingerprints, langid, packing, pattern_packing,
               periodic_runs, quality, simhash, substring, toxicity)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": fingerprints.op1_fingerprints,
        "op2_decontamination": decontam.op2_decontamination,
        "op3_language": langid.op3_language,
        "op4_quality": quality.op4_quality,
        "op5_chat": chat.op5_chat,
        "op6_packing": packing.op6_packing,
        "op7_simhash": simhash.op7_simhash,
        "op8_substring": substring.op8_substring,
        "op9_byte_bpe": bpe.op9_byte_bpe,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_pattern_packing": pattern_packing.op11_pattern_packing,
        "op12_periodic_runs": periodic_runs.op12_periodic_runs,
        "op13_filter_audit": filter_audit.op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontam.ORACLE,
        "op5_chat": chat.ORACLE,
        "op13_filter_audit": filter_audit.ORACLE,
    }
