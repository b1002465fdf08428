"""The document tree: typed blocks in order become nodes with parents, paths and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.text import label_value, slugify
from quire.operators.sequence import occurrence_ids, ordered_list

#: What blocks hold, in document order by seq.
BLOCK = "doc string, seq bigint, kind string, level int, text string, md string, page int, region string, header array<string>, rows array<array<string>>, caption string"
LEVELS = 4


#: Kinds of blocks that make nodes by themselves, and types of a stat block's parts.
KNOWN = ("heading", "paragraph", "bullet", "step", "table", "callout", "property", "subtitle", "definition")
PARTS = {"statblock.meta": "meta", "statblock.header": "header", "statblock.ability": "ability", "statblock.section": "section_mark", "statblock.body": "paragraph"}


def grouped(blocks: DataFrame) -> DataFrame:
    """blocks with gkind and gseq, the kind and first block of the group that takes a block, null if none does.

    A stat block takes what follows its name up to another name or a stranger; a contents node the
    contents lines of a page; a sidebar the blocks of its region. Parts of a stat block without a name
    belong nowhere.
    """
    w = W.partitionBy("doc").orderBy("seq")
    kind = F.col("kind")
    group = F.when(kind.startswith("statblock."), "statblock").when(kind == "toc", "toc").when(F.col("region").startswith("sidebar"), "sidebar")
    key = F.when(group == "statblock", group).when(group == "toc", F.concat_ws("/", group, "page")).when(group == "sidebar", F.concat_ws("/", group, "page", "region"))
    at = blocks.withColumn("gkind", group).withColumn("__key", key)
    opens = F.col("__key").isNotNull() & (~F.col("__key").eqNullSafe(F.lag("__key").over(w)) | (kind == "statblock.name"))
    at = at.withColumn("__open", F.when(opens, F.struct("seq", F.col("kind").alias("first"))))
    last = F.last("__open", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    whole = F.col("gkind").isNotNull() & ((F.col("gkind") != "statblock") | (last["first"] == "statblock.name"))
    at = at.withColumn("gseq", F.when(whole, last["seq"]))
    return at.withColumn("gkind", F.when(F.col("gseq").isNotNull(), F.col("gkind"))).drop("__key", "__open")


def _heads(at: DataFrame) -> DataFrame:
    """A row for each group: name or title, text, and for contents its entries as rows of title and page."""
    own = at.filter("gseq is not null")
    title = F.array_join(ordered_list(["seq"], "text", F.col("kind").isin("statblock.name", "sidebar_title")), " ")
    got = own.groupBy("doc", "gkind", "gseq").agg(title.alias("title"), F.array_join(ordered_list(["seq"], "text"), " ").alias("all"), F.min_by("page", "seq").alias("page"), F.min_by("region", "seq").alias("region"))
    lines = own.filter("gkind = 'toc'").select(F.struct("doc", "gseq").alias("page"), F.lit(0).alias("column"), "seq", "text")
    entry = F.struct("seq", F.array("title", F.coalesce(F.col("target").cast("string"), F.lit(""))).alias("e"))
    told = contents(lines).groupBy("page").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("entries"))
    told = told.select("page.doc", "page.gseq", "entries")
    return got.join(told, ["doc", "gseq"], "left").select(
        "doc", F.col("gseq").alias("seq"), F.col("gkind").alias("kind"), F.lit(None).cast("int").alias("level"), F.when(F.col("gkind") == "toc", F.col("all")).alias("text"), F.lit(None).cast("string").alias("md"),
        "page", "region", F.lit(None).cast("array<string>").alias("header"), F.col("entries").alias("rows"), F.lit(None).cast("string").alias("caption"), F.lit(None).cast("string").alias("gkind"), F.lit(None).cast("bigint").alias("gseq"), F.col("title"), F.lit(True).alias("head"),
    )


def nodes(blocks: DataFrame, book: str = "") -> DataFrame:
    """Nodes (doc, node_id, parent_id, pos, type, level, title, text, md, label, value, caption, header, rows, page, path).

    A heading closes those of its level and below; other blocks hang from the last open one, and those
    of a group from the group's own node. Ids are slugs of titles, numbered by occurrence; other nodes
    have their place as id. Blocks of other kinds make no nodes; see dropped.
    """
    w = W.partitionBy("doc").orderBy("seq", ~F.col("head")).rowsBetween(W.unboundedPreceding, 0)
    at = grouped(blocks)
    heads = _heads(at)
    taken = F.col("kind").isin("statblock.name", "sidebar_title", "toc") & F.col("gseq").isNotNull()
    at = at.filter(~taken & (F.col("gseq").isNotNull() | F.col("kind").isin(*KNOWN)))
    at = at.select(*heads.columns[:-2], F.lit(None).cast("string").alias("title"), F.lit(False).alias("head")).unionByName(heads)
    heading = (F.col("kind") == "heading") & F.col("level").isNotNull() & F.col("gseq").isNull()
    name = F.when(heading, F.col("text")).when(F.col("head"), F.nullif("title", F.lit("")))
    place = F.concat(F.when(F.col("head"), "~g").otherwise("~"), F.col("seq").cast("string"))
    base = F.coalesce(F.when(heading, slugify(F.col("text"))), F.nullif(slugify(name), F.lit("")), place)
    at = occurrence_ids(at.withColumn("base", base), F.concat_ws("#", "doc", "base"), ["seq", ~F.col("head")], "node_id")
    at = at.withColumn("node_id", F.substring_index("node_id", "#", -1))
    for k in range(1, LEVELS + 1):
        at = at.withColumn(f"h{k}", F.last(F.when(heading & (F.col("level") == k), F.struct("seq", F.col("node_id").alias("id"), F.col("text").alias("t"))), ignorenulls=True).over(w))
    live = []
    for k in range(1, LEVELS + 1):
        above = F.greatest(F.lit(-1).cast("bigint"), *[F.coalesce(F.col(f"h{j}")["seq"], F.lit(-1)) for j in range(1, k)], F.lit(-1).cast("bigint"))
        open_ = (F.col(f"h{k}")["seq"] > above) & ~(heading & (F.lit(k) >= F.col("level")))
        live.append(F.when(open_, F.col(f"h{k}")))
    group = F.last(F.when(F.col("head"), F.struct("seq", F.col("node_id").alias("id"), F.coalesce("title", F.lit("")).alias("t"))), ignorenulls=True).over(w)
    inner = F.when(F.col("gseq").isNotNull(), F.array(group)).otherwise(F.array().cast("array<struct<seq: bigint, id: string, t: string>>"))
    stack = F.concat(F.filter(F.array(*live), lambda x: x.isNotNull()), inner)
    label, value = label_value(F.col("text"))
    prop = (F.col("kind") == "property") & F.col("gseq").isNull()
    part = F.col("kind")
    for one, kind in PARTS.items():
        part = F.when(F.col("kind") == one, kind).otherwise(part)
    part = F.when((F.col("gkind") == "sidebar") & (F.col("kind") != "table"), "paragraph").otherwise(part)
    return at.withColumn("stack", stack).select(
        "doc",
        "node_id",
        F.try_element_at("stack", F.lit(-1))["id"].alias("parent_id"),
        F.col("seq").alias("pos"),
        F.when(heading, F.element_at(F.array(F.lit("chapter"), F.lit("section"), F.lit("subsection"), F.lit("entry")), F.least(F.col("level"), F.lit(4)))).otherwise(part).alias("type"),
        F.when(heading, F.col("level")).alias("level"),
        name.alias("title"),
        F.when(~heading, F.col("text")).alias("text"),
        F.when(~heading, F.coalesce("md", "text")).alias("md"),
        F.when(prop, label).alias("label"),
        F.when(prop, value).alias("value"),
        "caption",
        "header",
        "rows",
        "page",
        F.transform("stack", lambda x: x["t"]).alias("path"),
    )


def dropped(blocks: DataFrame) -> DataFrame:
    """Blocks with text that no node takes, counted by kind."""
    lost = F.col("gseq").isNull() & (~F.col("kind").isin(*KNOWN) | ((F.col("kind") == "heading") & F.col("level").isNull()))
    return grouped(blocks).filter(lost & (F.trim("text") != "")).groupBy("kind").agg(F.count("*").alias("n"))


def summary(of: DataFrame) -> DataFrame:
    return of.groupBy("type").agg(F.count("*").alias("n"))


CHILD = ("pos", "type", "text", "md", "label", "value", "caption", "header", "rows", "page", "title")


def entries(of: DataFrame, kind: str = "entry", under: str | None = None) -> DataFrame:
    """Nodes of a type, with their children in order and provenance; under: only those with such an ancestor."""
    rows = of.filter(F.col("type") == kind)
    if under is not None:
        rows = rows.filter(F.array_contains("path", under))
    kids = of.filter("parent_id is not null").select("doc", F.col("parent_id").alias("node_id"), F.struct(*CHILD).alias("c")).groupBy("doc", "node_id").agg(F.array_sort(F.collect_list("c")).alias("children"))
    got = rows.select("doc", "node_id", "pos", "title", "path", "page").join(kids, ["doc", "node_id"], "left")
    pages = F.array_sort(F.array_distinct(F.filter(F.concat(F.array("page"), F.coalesce(F.transform("children", lambda c: c["page"]), F.array().cast("array<int>"))), lambda p: p.isNotNull())))
    return got.withColumn("pages", pages)


def content(children: Column, skip: list[str]) -> Column:
    """Children as blocks of a record: text ones with md and text, tables with their grid; skip leaves types out."""
    kept = F.filter(children, lambda c: ~c["type"].isin(skip))
    return F.transform(kept, lambda c: F.struct(c["type"].alias("type"), c["page"].alias("page"), c["md"].alias("md"), c["text"].alias("text"), c["caption"].alias("caption"), c["header"].alias("header"), c["rows"].alias("rows")))


def plain(children: Column, skip: list[str]) -> Column:
    """Children's texts, blank lines between."""
    return F.array_join(F.transform(F.filter(children, lambda c: ~c["type"].isin(skip) & (F.trim(F.coalesce(c["text"], F.lit(""))) != "")), lambda c: c["text"]), "\n\n")


def contents(lines: DataFrame) -> DataFrame:
    """Entries of a contents list from its lines (page, column, seq, text): a line without page number is carried to the next of its column."""
    from quire.functions.parse import contents_entry
    from quire.operators.sequence import carried

    title, page = contents_entry(F.col("text"))
    at = carried(lines.withColumn("t", title).withColumn("p", page), ["page", "column"], ["seq"], F.col("p").isNotNull())
    return at.groupBy("page", "column", "run").agg(F.array_join(ordered_list(["seq"], "t"), " ").alias("title"), F.max("p").alias("target"), F.min("seq").alias("seq"))
