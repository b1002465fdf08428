"""Checks as data: expectations joined with counts, and a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(ids: DataFrame) -> DataFrame:
    """ids that stand more than once among all collections."""
    return ids.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")


def compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, expected, actual, passed): a missing count fails, a null expectation is met by no rows."""
    return expected.join(actual, "name", "full_outer").select("name", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("passed"))


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.every("passed").alias("ok"))


def report(title: str, checks: DataFrame, most: int = 50) -> tuple[str, bool]:
    """A Markdown report and whether all checks passed; failures come first, most rows at most are shown of them."""
    rows = checks.orderBy("passed", "name").limit(most + 500).collect()
    ok = all(r["passed"] for r in rows)
    body = [f"| {r['name']} | {r['expected']} | {r['actual']} | {'OK' if r['passed'] else 'FAIL'} |" for r in rows]
    return "\n".join([f"# {title}", "", "| Check | Expected | Actual | Result |", "|---|---|---|---|", *body, "", "OK" if ok else "FAIL", ""]), ok


def missing(some: DataFrame, among: DataFrame, key: str) -> DataFrame:
    """Keys of some that aren't among the others, each once: none where the one is a subset."""
    return some.select(key).distinct().join(among.select(key).distinct(), key, "left_anti")
