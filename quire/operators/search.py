"""Full-text search on an inverted index, faceted filters and keyed lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import unaccented

K1, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    """Lower-case words without accents."""
    return F.filter(F.split(F.lower(unaccented(text)), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def postings(docs: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(token, id, field, tf), to be written clustered by token. Unlisted columns stay unindexed."""
    each = [docs.select(F.col(id_col).alias("id"), F.lit(f).alias("field"), F.explode(tokens(F.col(f))).alias("token")) for f in fields]
    rows = each[0]
    for more in each[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("token", "id", "field").agg(F.count("*").alias("tf"))


def match_all(index: DataFrame, query: list[str]) -> DataFrame:
    """Ids with every word of the query."""
    words = sorted(set(query))
    return index.filter(F.col("token").isin(words)).groupBy("id").agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(words)).select("id")


def ranked(index: DataFrame, query: list[str], every: bool = False) -> DataFrame:
    """(id, score) by BM25 over the words of the query, any of them or every one.

    Lengths and the collection's size come from the index in one aggregation; only the query's postings are joined.
    """
    words = sorted(set(query))
    lengths = index.groupBy("id").agg(F.sum("tf").alias("length"))
    whole = lengths.agg(F.count("*").alias("docs"), F.avg("length").alias("mean"))
    hits = index.filter(F.col("token").isin(words)).groupBy("token", "id").agg(F.sum("tf").alias("tf"))
    df = hits.groupBy("token").agg(F.count("*").alias("df"))
    at = hits.join(df, "token").join(lengths, "id").crossJoin(F.broadcast(whole))  # one row
    idf = F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    got = at.groupBy("id").agg(F.round(F.sum(part), 6).alias("score"), F.count("*").alias("n"))
    return (got.filter(F.col("n") == len(words)) if every else got).select("id", "score")


def facets(df: DataFrame, equal: dict[str, object], least: dict[str, float | None] | None = None) -> DataFrame:
    """Rows that fit all given facets; a facet without value is not asked for. A list means any of it; an array column, that it has it."""
    for c, v in equal.items():
        if v is None:
            continue
        if df.schema[c].dataType.typeName() == "array":
            df = df.filter(F.array_contains(c, v))
        else:
            df = df.filter(F.col(c).isin(v) if isinstance(v, list) else F.col(c) == v)
    for c, v in (least or {}).items():
        if v is not None:
            df = df.filter(F.coalesce(F.col(c) >= v, F.lit(False)))
    return df


def facet_values(df: DataFrame, column: str, locale: str = "es") -> DataFrame:
    """A column's distinct values, arrays flattened, without nulls, in the locale's order."""
    value = F.explode(column) if df.schema[column].dataType.typeName() == "array" else F.col(column)
    return df.select(value.alias("value")).filter("value is not null").distinct().orderBy(F.collate("value", locale))
