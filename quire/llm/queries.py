"""The corpus operators as queries over the given tables, each with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, langid, mixing, quality, rules, secrets, simhash, substring, toxicity, warc
from quire.llm.common import table
from quire.llm.sql import SQL


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark, table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_secrets": op6_secrets,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_simhash": op9_simhash,
    "op10_substring": op10_substring,
}

ORACLES = {k: v for k, v in SQL.items() if k in QUERIES}
