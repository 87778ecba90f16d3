"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import bpe, chat_format, decontaminate, license_scan, line_dedup, quality_rules, simhash, substring_dedup, suffix_dedup, warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": substring_dedup.op1,
        "op2_decontaminate": decontaminate.op2,
        "op3_chat_format": chat_format.op3,
        "op4_quality_rules": quality_rules.op4,
        "op5_license_scan": license_scan.op5,
        "op6_line_dedup": line_dedup.op6,
        "op7_suffix_dedup": suffix_dedup.op7,
        "op8_warc": warc.op8,
        "op10_byte_bpe": bpe.op10,
        "op9_simhash_near_dedup": simhash.op9,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontaminate": decontaminate.OP2_SQL,
        "op3_chat_format": chat_format.OP3_SQL,
        "op4_quality_rules": quality_rules.OP4_SQL,
        "op5_license_scan": license_scan.op5_sql(),
        "op6_line_dedup": line_dedup.OP6_SQL,
        "op8_warc": warc.OP8_SQL,
    }
