"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last
return the columns of documents; n_chars follows the text where a stage changes it. The last stage adds
copy_no: a document that the mix takes n times has n rows. run() stores each stage's rows as Parquet in
the shared folder and goes on from there, so a lost executor repeats tasks of one stage at most.

Nulls, empty tables, repeated rows and other columns: as the operators' modules say. A document without
a language is rejected; of a near-duplicate group one document stays; benchmark passages are cut out,
and documents that are mostly such passages go; secrets are replaced; sources are mixed by weight.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, langid, mixing, secrets, simhash
from quire.llm.common import shared_dir, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that no language is found for go."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: passages of benchmark items are cut out; a document that is more than half such passages goes."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), max_coverage=0.5, count_col="n_chars")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: secrets are replaced by a mark."""
    return secrets.redacted(docs, count_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", hide_secrets),
    ("mix", mix),
]

#: SQL can't express code lengths, fingerprints or automata.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
