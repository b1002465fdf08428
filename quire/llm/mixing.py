"""Mixing sources to target weights by entropy balancing.

Each document gets a rate r of at most `most` copies. Among all rates with the right number of words
from each source, those nearest to 1 in relative entropy are exponential tilts, r = exp(l * x), with x
the document's size over its source's mean size and one multiplier l for each source. The multipliers
solve a convex dual; Newton steps on the logarithm of the taken words, kept within a bracket, find
them. Rates are then rounded into whole copies, largest sizes first, each rounding making good the
words that the ones before took too many or too few.

Documents of one source and size are alike to the mix, so all work but the last is on counts of such
cells. A cell's documents are ranked in parts of about TOGETHER; a document that is there very often is
ranked as one with its count. Sums are exact decimals: reruns and other partitionings agree. DataFrame
functions only.

Nulls: a null text has size 0 and takes nothing; documents of null source form a source of their own.
Sources without words have target 0. Repeated rows are documents like any other, and interchangeable.
Ties: of documents of one size those with the least hash of id and text get the copies that are over. A
text's words must fit a row. An empty table gives an empty result. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import columns_of, cut, fresh, heavy_keys, lookup, once_each, row_mark

BLANKS = " \t\n\x0b\f\r"
EXACT = "decimal(38,9)"
#: Documents of a cell that are ranked together.
TOGETHER = 250


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """sizes: (source, source_size). Adds target: share of all words by weight, sources in code-point order, null last.

    A target stops at most times its source's size; what is over goes to the others by weight. That
    is one level v with target = min(cap, v * weight): with sources in order of cap over weight, v is
    what is left after the first of them have stopped, over the weights of the rest.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    lot = math.lcm(*weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("*", weight.alias("w"), (F.col("source_size") * most).cast("decimal(38,0)").alias("cap"))
    s = s.select("*", (F.col("cap") * lot / F.col("w")).cast("decimal(38,0)").alias("ratio"))
    before = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.currentRow, W.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    s = s.select("*", F.coalesce(F.sum("cap").over(before), zero).cast("double").alias("gone"), F.sum("w").over(after).cast("double").alias("rest"), F.sum("source_size").over(W.partitionBy()).cast("double").alias("total"))
    level = s.select("*", ((F.lit(share) * F.col("total") - F.col("gone")) / F.col("rest")).alias("v"))
    level = level.select("*", F.min(F.when(F.col("v") * lot <= F.col("ratio").cast("double"), F.struct("ratio", "v"))).over(W.partitionBy())["v"].alias("level"))
    return level.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce("level", F.lit(math.inf)) * F.col("w")).alias("target"))


def multipliers(cells: DataFrame, wanted: DataFrame, *, most: int = 3, rounds: int = 60, near: float = 1e-7) -> DataFrame:
    """cells: (s, size, n); wanted: (s, source_size, n_docs, target). (s, l) with the taken words within near of the target."""
    top = math.log(most)
    known = (F.col("target") < most * F.col("source_size")) & (F.col("source_size") > 0)
    state = cut(wanted.filter(known).select("s", "source_size", "n_docs", "target", F.lit(0.0).alias("l"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(False).alias("done")))
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    tilt = F.least(F.col("l") * x, F.lit(top))
    words = F.col("n") * F.col("size") * F.exp(tilt)
    slope = F.when(F.col("l") * x < top, words * x).otherwise(0.0)
    for _ in range(rounds):
        sums = cells.join(state.filter("not done"), "s").groupBy("s").agg(F.sum(words.cast(EXACT)).cast("double").alias("f"), F.sum(slope.cast(EXACT)).cast("double").alias("d"))
        at = state.join(sums, "s", "left")
        low, high = F.when(F.col("f") < F.col("target"), F.col("l")).otherwise(F.col("lo")), F.when(F.col("f") >= F.col("target"), F.col("l")).otherwise(F.col("hi"))
        step = F.col("l") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("d")
        middle = F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        good = F.col("step").isNotNull() & (F.col("lo").isNull() | (F.col("step") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("step") < F.col("hi"))) & (F.abs("step") < 1e6)
        state = at.select("*", (F.col("done") | F.col("f").isNull() | (F.abs(F.col("f") - F.col("target")) <= near * F.col("target"))).alias("ok"), low.alias("lo2"), high.alias("hi2"), F.when((F.col("f") > 0) & (F.col("d") > 0), step).alias("step"))
        state = state.select("s", "source_size", "n_docs", "target", "l", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "ok", "step")
        state = cut(state.select("s", "source_size", "n_docs", "target", F.when(F.col("ok"), F.col("l")).when(good, F.col("step")).otherwise(middle).alias("l"), "lo", "hi", F.col("ok").alias("done")))
        if state.filter("not done").isEmpty():
            break
    return state.select("s", "l")


def _rounded(cells: DataFrame, *, most: int) -> DataFrame:
    """cells: (s, size, n, r). Adds k, the copies of a cell in all: largest sizes first, each making good the error so far."""
    whole = cells.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("size", "n", "r")), asc=False).alias("own"))
    start = F.expr("struct(cast(0 as double) as due, cast(0 as bigint) as taken, cast(array() as array<bigint>) as k)")

    def step(acc, c):
        due = acc["due"] + c["n"] * c["r"] * c["size"]
        k = F.when(c["size"] > 0, F.least(F.greatest(F.round((due - acc["taken"]) / c["size"]).cast("bigint"), F.lit(0)), c["n"] * most)).otherwise(0).cast("bigint")
        return F.struct(due.alias("due"), (acc["taken"] + k * c["size"]).alias("taken"), F.concat(acc["k"], F.array(k)).alias("k"))

    folded = whole.select("s", "own", F.aggregate("own", start, step, lambda acc: acc["k"]).alias("k"))
    return folded.select("s", F.explode(F.arrays_zip("own", "k")).alias("c")).select("s", "c.own.size", "c.own.n", "c.k")


def copies(rows: DataFrame, *, id_col: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """rows: (id_col, source, size bigint, h bigint, ...). Adds source_size, target and copies; h breaks ties.

    Equal rows are interchangeable. What is gathered at once: one row for each size that a source has.
    """
    rows = cut(rows.select("*", F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")).alias("s")))
    cells = cut(rows.groupBy("s", "size").agg(F.count("*").alias("n")))
    per = cells.groupBy("s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    per = per.select("*", F.when(F.col("s") != "-", F.substring("s", 2, 1 << 30)).alias("source"))
    wanted = targets(per.select("source", "source_size"), weights=weights, share=share, most=most)
    wanted = cut(wanted.select(F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")).alias("s"), "target").join(per.drop("source"), "s"))
    found = multipliers(cells, wanted, most=most)
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    rate = F.when(F.col("source_size") == 0, 0.0).when(F.col("l").isNull(), float(most)).otherwise(F.exp(F.least(F.col("l") * x, F.lit(math.log(most)))))
    rated = cells.join(wanted.join(found, "s", "left"), "s").select("s", "size", "n", rate.alias("r"))
    counted = _rounded(rated, most=most).join(wanted.select("s", "source_size", "target"), "s")
    cell = F.concat_ws(" ", "size", "s").alias("cell")
    counted = cut(counted.select(cell, "n", "k", "source_size", "target"))
    # one document over and over is one unit of m rows
    rows = rows.select("*", cell)
    repeats = rows.groupBy("h").agg(F.count("*").alias("m"))
    hot = heavy_keys(repeats, "h", "m")
    units = rows.select("*", F.lit(1).cast("bigint").alias("m"))
    if hot:
        keys = F.broadcast(rows.sparkSession.createDataFrame([(h,) for h in hot], "h bigint"))
        names = [c for c in rows.columns if c not in ("h", "cell")]
        again = rows.join(keys, "h", "left_semi")
        each = again.groupBy("cell", "h").agg(*[F.first(c).alias(c) for c in names], F.count("*").alias("m"))
        units = units.join(keys, "h", "left_anti").unionByName(each)
    part = F.pmod(F.col("h"), F.greatest(F.col("n").cast("long") / TOGETHER, F.lit(1)).cast("long")).alias("part")
    dealt = cut(lookup(units, counted, "cell", "n").select("*", part))
    parts = dealt.groupBy("cell", "part").agg(F.sum("m").alias("own"), F.first("n").alias("n"), F.first("k").alias("k"))
    so_far = F.sum("own").over(W.partitionBy("cell").orderBy("part"))
    extra = F.col("k") % F.col("n")
    share_of = lambda c: F.floor(extra.cast("decimal(38,0)") * c / F.col("n"))
    parts = parts.select("*", so_far.alias("c")).select("cell", "part", (share_of(F.col("c")) - share_of(F.col("c") - F.col("own"))).cast("bigint").alias("extra"))
    upto = F.sum("m").over(W.partitionBy("cell", "part").orderBy("h", id_col).rowsBetween(W.unboundedPreceding, 0))
    ranked = dealt.join(parts, ["cell", "part"]).select("*", upto.alias("upto"))
    whole = F.floor(F.col("k") / F.col("n")).cast("bigint")
    over = F.least(F.greatest(F.col("extra") - F.col("upto") + F.col("m"), F.lit(0)), F.col("m"))
    out = [*[c for c in rows.columns if c not in ("s", "cell")], "source_size", "target"]
    if not hot:
        return ranked.select(*out, (whole + over).alias("copies"))
    ranked = cut(ranked.select("*", whole.alias("whole"), over.alias("over")))
    single = ranked.join(keys, "h", "left_anti").select(*out, (F.col("whole") + F.col("over")).alias("copies"))
    # rows of a unit are numbered where they are stored, and the numbers of other places added
    placed = again.select("*", F.spark_partition_id().alias("place"))
    before = W.partitionBy("cell", "h").orderBy("place")
    first = placed.groupBy("cell", "h", "place").agg(F.count("*").alias("here")).select("cell", "h", "place", (F.sum("here").over(before) - F.col("here")).alias("before"))
    number = F.row_number().over(W.partitionBy("cell", "h", "place").orderBy("h")) + F.col("before")
    told = F.broadcast(ranked.join(keys, "h", "left_semi").select("cell", "h", "source_size", "target", "whole", "over"))
    many = placed.join(first, ["cell", "h", "place"]).select("*", number.alias("number")).join(told, ["cell", "h"])
    return single.unionByName(many.select(*out, (F.col("whole") + (F.col("number") <= F.col("over")).cast("bigint")).alias("copies")))


def sized(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col), F.col(source_col).alias("source"), F.size(words_of(F.col(text_col))).cast("bigint").alias("size"), F.xxhash64(id_col, text_col).alias("h"))


def report(docs: DataFrame) -> DataFrame:
    return copies(sized(docs)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """docs with each document as often as the mix takes it; a column copy_no (1, 2, ...) comes last (copy_no_ where docs has one).

    Rows that are equal in all columns are one document here, which gets the copies of all of them.
    """
    mark, made, count, number = fresh(docs, "__mark", "__copies", "__count", "copy_no")
    marked = docs.select("*", row_mark(docs).alias(mark))
    narrow = marked.select(F.col(mark).alias("mark"), F.col(source_col).alias("source"), F.size(words_of(F.col(text_col))).cast("bigint").alias("size"), F.xxhash64(id_col, text_col).alias("h"))
    got = copies(narrow, id_col="mark", weights=weights, share=share, most=most).groupBy("mark").agg(F.sum("copies").alias(made), F.count("*").alias(count))
    got = cut(got.filter(F.col(made) > 0).withColumnRenamed("mark", mark))
    rows = once_each(marked, got, mark, count)
    return rows.select(*columns_of(docs), F.explode(F.sequence(F.lit(1), F.col(made).cast("int"))).alias(number))
