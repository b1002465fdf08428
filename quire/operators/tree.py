"""Trees as adjacency rows (node_id, parent_id, pos, type, title): paths, walks, context, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting of rows in a recursive query, and its default.
ROW_LIMIT, ROWS = "spark.sql.cteRecursionRowLimit", "1000000"


def walk(spark: SparkSession, nodes: DataFrame, *, label: str = "title", levels: int = 100) -> DataFrame:
    """nodes with depth and path: the ancestors' labels from the root down, not their own. One recursive query, a join for each level.

    A tree of more levels fails. Spark stops recursive queries at a number of rows, read when they run; as a tree has
    as many as it has, that limit is lifted for the session unless the user has set one.
    """
    if spark.conf.get(ROW_LIMIT) == ROWS:
        spark.conf.set(ROW_LIMIT, "-1")
    return spark.sql(
        f"""
        WITH RECURSIVE t(node_id, parent_id, pos, type, label, depth, path) MAX RECURSION LEVEL {levels} AS (
            SELECT node_id, parent_id, pos, type, {label}, 0, CAST(array() AS ARRAY<STRING>) FROM {{nodes}} WHERE parent_id IS NULL
            UNION ALL
            SELECT n.node_id, n.parent_id, n.pos, n.type, n.{label}, t.depth + 1, array_append(t.path, t.label) FROM {{nodes}} n JOIN t ON n.parent_id = t.node_id)
        SELECT * FROM t""",
        nodes=nodes,
    )


def context(path: Column) -> Column:
    """Ancestors less the root."""
    return F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0)))


def parent_title(path: Column) -> Column:
    return F.try_element_at(path, F.lit(-1))


def entries_under(walked: DataFrame, kind: str, ancestor: str) -> DataFrame:
    return walked.filter((F.col("type") == kind) & F.array_contains("path", ancestor))


def outline(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """(parent title, its children's titles in order)."""
    kids = nodes.groupBy(F.col("parent_id").alias("p")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda x: x["title"]).alias("children"))
    return parents.join(kids, parents["node_id"] == kids["p"], "left").select(parents["title"], F.coalesce("children", F.array().cast("array<string>")).alias("children"))


def markdown_table(header: list[str], rows: Column) -> Column:
    """Header, rule and rows (array of arrays of strings) as a Markdown table."""
    from quire.functions.text import cell

    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    body = F.transform(rows, lambda r: line(F.transform(r, cell)))
    head = F.array(F.lit("| " + " | ".join(header) + " |"), F.lit("|" + "---|" * len(header)))
    return F.array_join(F.concat(head, body), "\n")


#: Heading depth by node type; other types are text.
DEPTHS = {"chapter": 1, "section": 2, "subsection": 3, "entry": 4}


def markdown(nodes: DataFrame, by: str) -> DataFrame:
    """(by, text): nodes (pos, type, title, md) of each chapter rendered in order, blank lines between, three or more line ends squeezed.

    Callouts and contents nodes are rendered too.
    """
    kind = F.col("type")
    text = F.coalesce(F.col("md"), F.lit(""))
    out = F.when(kind == "callout", F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))).when(kind == "item", F.concat(F.lit("- "), text)).when(kind == "step", F.concat(F.lit("1. "), text))
    for name, depth in DEPTHS.items():
        out = out.when(kind == name, F.concat(F.lit("#" * depth + " "), F.coalesce("title", F.lit(""))))
    out = out.otherwise(text)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", out.alias("t")))), lambda x: x["t"]), "\n\n")
    return nodes.groupBy(by).agg(F.concat(F.trim(F.regexp_replace(joined, "\n{3,}", "\n\n")), F.lit("\n")).alias("text"))


#: Entries beyond which a section's entries get pages of their own.
SPLIT = 40


def site_pages(walked: DataFrame, most: int = SPLIT) -> DataFrame:
    """(kind, node_id): a page for each chapter without sections and for each section; sections with more than most entries become an index and a page for each entry.

    walked: nodes with type and parent_id.
    """
    chapters, sections, entries = (walked.filter(F.col("type") == t).select("node_id", "parent_id") for t in ("chapter", "section", "entry"))
    counts = entries.groupBy(F.col("parent_id").alias("s")).agg(F.count("*").alias("n"))
    sized = sections.join(counts, F.col("node_id") == F.col("s"), "left").select("node_id", (F.coalesce("n", F.lit(0)) > most).alias("split"))
    bare = chapters.join(sections.select(F.col("parent_id").alias("c")).distinct(), F.col("node_id") == F.col("c"), "left_anti").select(F.lit("chapter").alias("kind"), "node_id")
    own = sized.select(F.when(F.col("split"), "index").otherwise("section").alias("kind"), "node_id")
    single = entries.join(sized.filter("split").select(F.col("node_id").alias("s")), F.col("parent_id") == F.col("s"), "left_semi").select(F.lit("entry").alias("kind"), "node_id")
    return bare.unionByName(own).unionByName(single)


def first_below(walked: DataFrame, condition: Column, take: list[str]) -> DataFrame:
    """(ancestor, take): for each title on a path the first node in document order below it for which the condition holds."""
    at = walked.filter(condition).select("pos", *take, F.explode(F.array_distinct("path")).alias("ancestor"))
    return at.groupBy("ancestor").agg(F.min_by(F.struct(*take), F.struct("pos", *take)).alias("f")).select("ancestor", *[F.col(f"f.{c}").alias(c) for c in take])


def enumerated(groups: list[tuple[str, Column]]) -> Column:
    """Elements of several arrays of (md) structs as one array of (part, no, md), groups in the order given, nulls as none."""

    def numbered(part: str, blocks: Column) -> Column:
        return F.transform(F.coalesce(blocks, F.array().cast("array<struct<md: string>>")), lambda b, i: F.struct(F.lit(part).alias("part"), (i + 1).alias("no"), b["md"].alias("md")))

    return F.flatten(F.array(*[numbered(p, c) for p, c in groups]))
