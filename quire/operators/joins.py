"""Joins that Spark has no operator for: first match, containment, as-of within a tolerance, snapshots, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_match(rows: DataFrame, rules: DataFrame, condition: Column, key: list[str], order: str, take: list[str]) -> DataFrame:
    """rows with the columns take of the first rule (by order) that fits, null if none.

    rules is a declared rule set; it is broadcast by its size, not by hint. key must name a row.
    """
    met = rows.join(rules, condition, "left")
    return met.groupBy(*key).agg(F.min_by(F.struct(*take), order).alias("__r")).select(*key, *[F.col(f"__r.{c}").alias(c) for c in take])


def contains(x: Column, y: Column, box: dict[str, Column], pad: float = 0, top: float | None = None, bottom: float | None = None) -> Column:
    """Whether the point lies in the box, borders and pads included."""
    up, down = pad if top is None else top, pad if bottom is None else bottom
    return x.between(box["x0"] - pad, box["x1"] + pad) & y.between(box["y0"] - up, box["y1"] + down)


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, tolerance: float, take: list[str], *, strict: bool = True, forward: bool = False) -> DataFrame:
    """left with columns take of right's nearest row before (or after) it, tolerance away at most, null if none.

    at: seconds or any number. Time is dealt into buckets of the tolerance, right rows stand in their
    bucket and the next; so one busy key spreads over its buckets. Ties at one time: the greatest take.
    """
    sign = -1 if forward else 1
    bucket = lambda c: F.floor(c * sign / tolerance).cast("bigint")
    right = right.select(*by, F.col(at).alias("__at"), F.struct(F.col(at).alias("__at"), *take).alias("__r"), F.explode(F.array(bucket(F.col(at)), bucket(F.col(at)) + 1)).alias("__b"))
    sides = left.select("*", F.lit(None).cast(right.schema["__r"].dataType).alias("__r"), bucket(F.col(at)).alias("__b"), F.lit(1).alias("__left"))
    both = sides.unionByName(right.withColumnRenamed("__at", at).withColumn("__left", F.lit(0)), allowMissingColumns=True)
    # at one time: with strict the left row comes first and does not see the right one
    order = [F.col(at) * sign, F.col("__left").desc() if strict else F.col("__left"), F.col("__r").asc_nulls_first()]
    seen = F.last("__r", ignorenulls=True).over(W.partitionBy(*by, "__b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    got = both.withColumn("__r", seen).filter("__left = 1")
    near = F.abs(F.col(at) - F.col("__r.__at")) <= tolerance
    return got.select(*[F.col(c) for c in left.columns], *[F.when(near, F.col(f"__r.{c}")).alias(f"near_{c}") for c in take])


def names_first(names: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the first by order."""
    others = [c for c in names.columns if c != key]
    return names.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__n")).select(key, *[F.col(f"__n.{c}").alias(c) for c in others])


def resolve(mentions: DataFrame, names: DataFrame, key: str, source: str, target: str, order: list[str]) -> DataFrame:
    """Links (source, target, pos): mentions whose key is a name, the first definition wins, no links to oneself, each link once."""
    got = mentions.join(names_first(names, key, order).select(key, F.col(target)), key)
    return got.filter(F.col(source) != F.col(target)).groupBy(source, target).agg(F.min("pos").alias("pos"))


def unresolved(mentions: DataFrame, names: DataFrame, key: str, most: int = 200) -> DataFrame:
    """The most frequent keys that aren't names."""
    return mentions.join(names.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(most)


def incoming(links: DataFrame, source: str, target: str) -> DataFrame:
    return links.groupBy(target).agg(F.array_sort(F.collect_list(source)).alias("sources"), F.count("*").alias("n"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, place: str, version: str) -> DataFrame:
    """Merges a snapshot (key, place, since, retired) with what there is now (key, place).

    added, kept, moved (the place differs), retired (gone; its first retirement stays) or returned.
    """
    o, n = old.alias("o"), new.alias("n")
    was, gone = F.col(f"o.{key}").isNotNull(), F.col("o.retired").isNotNull()
    here = F.col(f"n.{key}").isNotNull()
    status = F.when(~here, "retired").when(~was, "added").when(gone, "returned").when(F.col(f"o.{place}").eqNullSafe(F.col(f"n.{place}")), "kept").otherwise("moved")
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key),
        F.coalesce(f"n.{place}", f"o.{place}").alias(place),
        status.alias("status"),
        F.coalesce("o.since", F.lit(version)).alias("since"),
        F.when(status == "moved", F.col(f"o.{place}")).alias("moved_from"),
        F.when(status == "retired", F.coalesce("o.retired", F.lit(version))).alias("retired"),
    )
