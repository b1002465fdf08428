"""Operators on ordered rows: islands, bands, runs, fill-forward, numbering. Window functions and folds, one shuffle by key each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _window(by: list[str], order: list) -> W:
    return W.partitionBy(*by).orderBy(*order)


def islands(df: DataFrame, by: list[str], order: list, starts: Column, into: str = "run") -> DataFrame:
    """Numbers the runs of each group: a row for which starts holds (or the first) opens one. Runs count from 1."""
    w = _window(by, order)
    first = F.row_number().over(w) == 1
    marked = df.withColumn("__new", (first | F.coalesce(starts, F.lit(False))).cast("bigint"))
    return marked.withColumn(into, F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__new")


def gap_islands(df: DataFrame, by: list[str], order: list, value: Column, gap: float, into: str = "run") -> DataFrame:
    """A new run where value is more than gap past the row before."""
    return islands(df.withColumn("__gap", value - F.lag(value).over(_window(by, order))), by, order, F.col("__gap") > gap, into).drop("__gap")


def change_islands(df: DataFrame, by: list[str], order: list, key: Column, into: str = "run") -> DataFrame:
    """A new run where the key differs from the row before."""
    return islands(df.withColumn("__diff", ~key.eqNullSafe(F.lag(key).over(_window(by, order)))), by, order, F.col("__diff"), into).drop("__diff")


def anchored_bands(values: Column, width: float) -> Column:
    """Starts of bands over a sorted array: a new band where a value is more than width past the band's first."""
    return F.aggregate(values, F.array().cast("array<double>"), lambda acc, x: F.when((F.size(acc) == 0) | (x - F.try_element_at(acc, F.lit(-1)) > width), F.concat(acc, F.array(x.cast("double")))).otherwise(acc))


def band_of(x: Column, starts: Column, slack: float) -> Column:
    """Number of the last band that starts at x + slack or before, from 0."""
    return F.greatest(F.size(F.filter(starts, lambda s: x >= s - slack)) - 1, F.lit(0))


def merged_intervals(df: DataFrame, by: list[str], start: str, end: str, slack: float) -> DataFrame:
    """Unions of a group's intervals that overlap or lie within slack: (by, run, start, end, n)."""
    w = _window(by, [start, end])
    reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    at = islands(df.withColumn("__reach", reach), by, [start, end], F.col(start) > F.col("__reach") + slack)
    return at.groupBy(*by, "run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"))


def split_threshold(gaps: Column) -> Column:
    """The cut between small and large gaps.

    Gaps over a half, rounded to a tenth and sorted, those of at least half the greatest kept; the cut
    lies in the middle of the greatest jump in ratio if that is 1.15 or more, else one below the least.
    """
    sorted_gaps = F.array_sort(F.transform(F.filter(gaps, lambda g: g > 0.5), lambda g: F.bround(g, 1)))

    def cut(kept: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))), lambda i: F.struct((F.get(kept, i) / F.get(kept, i - 1)).alias("r"), (-i).alias("o"), ((F.get(kept, i) + F.get(kept, i - 1)) / 2).alias("m")))
        found = let(F.array_max(steps), lambda best: F.when((F.size(kept) > 1) & (best["r"] >= 1.15), best["m"]).otherwise(F.get(kept, F.lit(0)) - 1))
        return F.when(F.size(kept) == 0, 0.0).otherwise(found)

    half = lambda all_: let(F.array_max(all_), lambda most: F.filter(all_, lambda g: g * 2 >= most))
    return let(sorted_gaps, lambda all_: let(half(all_), cut))


def let(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def fill_forward(df: DataFrame, by: list[str], order: list, value: Column, into: str) -> DataFrame:
    return df.withColumn(into, F.last(value, ignorenulls=True).over(_window(by, order).rowsBetween(W.unboundedPreceding, 0)))


def carried(df: DataFrame, by: list[str], order: list, closes: Column, into: str = "run") -> DataFrame:
    """Rows up to and with one for which closes holds form a run; what is left at the end is the last run."""
    w = _window(by, order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(into, F.coalesce(F.sum(closes.cast("bigint")).over(w), F.lit(0)) + 1)


def leading_run(df: DataFrame, by: list[str], order: list, allowed: Column) -> DataFrame:
    """A group's rows before the first for which allowed doesn't hold."""
    w = _window(by, order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("__bad", F.sum((~F.coalesce(allowed, F.lit(False))).cast("int")).over(w)).filter("__bad = 0").drop("__bad")


def occurrence_ids(df: DataFrame, base: Column, order: list, into: str = "id") -> DataFrame:
    """base, base-2, base-3 ... in order."""
    n = F.row_number().over(W.partitionBy(base).orderBy(*order))
    return df.withColumn(into, F.when(n == 1, base).otherwise(F.concat(base, F.lit("-"), n.cast("string"))))


def heading_path(df: DataFrame, by: list[str], order: list, level: str, title: str, depth: int = 4, into: str = "path") -> DataFrame:
    """Titles of the open headings at each row: a heading closes those of its level and below; others hang from the last."""
    w = _window(by, order).rowsBetween(W.unboundedPreceding, 0)
    # for each level the last heading of it, if no higher one came later
    at = df.withColumn("__pos", F.row_number().over(_window(by, order)))
    for k in range(1, depth + 1):
        at = at.withColumn(f"__h{k}", F.last(F.when(F.col(level) == k, F.struct("__pos", F.col(title).alias("t"))), ignorenulls=True).over(w))
    live = []
    for k in range(1, depth + 1):
        higher = F.greatest(*[F.coalesce(F.col(f"__h{j}")["__pos"], F.lit(0)) for j in range(1, k)], F.lit(0)) if k > 1 else F.lit(0)
        live.append(F.when(F.col(f"__h{k}")["__pos"] > higher, F.col(f"__h{k}")["t"]))
    path = F.filter(F.array(*live), lambda x: x.isNotNull())
    return at.withColumn(into, path).drop("__pos", *[f"__h{k}" for k in range(1, depth + 1)])


def ordered_list(order: list[str], value: str, where: Column | None = None) -> Column:
    """Aggregate: values in order."""
    item = F.struct(*order, F.col(value).alias("__v"))
    return F.transform(F.array_sort(F.collect_list(item if where is None else F.when(where, item))), lambda x: x["__v"])



def weighted_mode(df: DataFrame, by: list[str], key: str, weight: Column, order: str, into: str = "mode") -> DataFrame:
    """For each group the key with the most weight; of equal ones the one seen first."""
    sums = df.groupBy(*by, key).agg(F.sum(weight).alias("__w"), F.min(order).alias("__first"))
    return sums.groupBy(*by).agg(F.min_by(key, F.struct((-F.col("__w")).alias("w"), "__first")).alias(into), F.max("__w").alias("weight"))


def leftmost_mode(df: DataFrame, by: list[str], value: str, into: str = "mode") -> DataFrame:
    """For each group the most frequent value; of equally frequent ones the least."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct((-F.col("__n")).alias("n"), value)).alias(into), F.max("__n").alias("n"))


def labelled_slices(s: Column, labels: list[str]) -> Column:
    """Map of label to the text up to the next label; of labels that begin alike the longest counts, later ones win."""
    import re

    any_label = "|".join(re.escape(x) for x in sorted(labels, key=len, reverse=True))
    pattern = rf"({any_label})([\s\S]*?)(?=(?:{any_label})|$)"
    keys = F.regexp_extract_all(s, F.lit(pattern), F.lit(1))
    values = F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(2)), lambda x: F.trim(x))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)
