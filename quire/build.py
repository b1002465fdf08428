"""The whole way from raw pages to exports, step by step or at once: python -m quire.build STEP --pages IN --out DIR --config FILE."""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.text import slugify
from quire.operators import blocks as B
from quire.operators import collect as C
from quire.operators import document as D
from quire.operators import joins as J
from quire.operators import layout as L
from quire.operators import tables as T
from quire.operators import tree, validate
from quire.operators.sequence import ordered_list
from quire.sources import pages as S
from quire.sources import sinks

STEPS = ("extract", "blocks", "document", "collect", "export", "validate")


def load_config(path: str) -> dict:
    """JSON, or YAML where a YAML reader is installed: colors, rules, layout, words, expected. A rule's colour may be a name."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("no YAML reader is installed; give the configuration as JSON") from e
            got = yaml.safe_load(f)
        else:
            got = json.load(f)
    return got


def rules_of(spark: SparkSession, config: dict) -> DataFrame:
    colors = config.get("colors", {})
    rows = [(i, r["role"], r["font"], float(r["size"]), colors.get(r.get("color"), r.get("color", 0)), r.get("level"), bool(r.get("discard"))) for i, r in enumerate(config["rules"], 1)]
    return spark.createDataFrame(rows, L.RULES)


def layout_of(config: dict) -> L.Layout:
    return L.Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in config.get("layout", {}).items()})


def blocks_of(pages: DataFrame, rules: DataFrame, layout: L.Layout, doc: str = "book", store: Callable[[str, DataFrame], DataFrame] = lambda _, df: df) -> DataFrame:
    """Blocks of all pages in document order: text folded from lines, tables as grids with the caption nearest above.

    store may keep what is read several times, and give it back.
    """
    found = store("regions", L.regions(S.rects(pages), layout))
    spans = store("spans", L.placed(L.with_roles(S.spans(pages), rules, layout), found, layout))
    lines = store("lines", L.reading_order(L.lines(spans, layout), layout))
    caption = F.col("role") == "table.caption"
    inside = F.coalesce(F.col("region").startswith("table"), F.lit(False))
    folded = B.page_blocks(lines.filter(~inside & ~F.coalesce(caption, F.lit(False))).select("page", F.col("seq").cast("int").alias("seq"), F.coalesce("role", F.lit("body")).alias("role"), "text", "md", "column", "region", "level", "size", "x0", "x1", "y", F.coalesce(F.col("parts")[0]["role"].isin(*layout.strong, *layout.strong_em), F.lit(False)).alias("bold"), F.coalesce(F.element_at("parts", -1)["role"].isin(*layout.strong, *layout.strong_em), F.lit(False)).alias("bold_open")))
    text = folded.select("page", F.col("seq").cast("double").alias("at"), "kind", "level", "text", "md", "region", F.lit(None).cast("array<string>").alias("header"), F.lit(None).cast("array<array<string>>").alias("rows"), F.lit(None).cast("string").alias("caption"), "column")
    # a table of which most lines are a stat block's is one of its parts
    stat = F.count_if(F.col("role").startswith("statblock.")) * 2 > F.count("*")
    where = lines.filter(inside).groupBy("page", "region").agg(F.min("seq").cast("double").alias("at"), F.min("x0").alias("t0"), F.max("x1").alias("t1"), F.min_by("column", "seq").alias("column"), F.coalesce(stat, F.lit(False)).alias("stat"), F.array_join(ordered_list(["seq"], "text"), " ").alias("lines"))
    grids = store("grids", T.grids(spans)).join(where, ["page", "region"])
    # each caption goes to one table: the nearest below it whose extent it overlaps
    named = lines.filter(caption).select("page", F.col("text").alias("caption"), F.col("y").alias("cy"), F.col("x0").alias("c0"), F.col("x1").alias("c1"))
    near = grids.join(named, "page").filter((F.col("y0") - F.col("cy") > 0) & (F.col("y0") - F.col("cy") <= 60) & (F.col("c0") <= F.col("t1") + 8) & (F.col("c1") >= F.col("t0") - 8))
    taken = near.withColumn("k", F.row_number().over(W.partitionBy("page", "caption", "cy").orderBy(F.col("y0") - F.col("cy"), "region"))).filter("k = 1")
    best = taken.groupBy("page", "region").agg(F.max_by("caption", "cy").alias("caption"))
    words = F.when(F.col("stat"), F.col("lines"))
    table = grids.join(best, ["page", "region"], "left").select("page", "at", F.when(F.col("stat"), "statblock.ability").otherwise("table").alias("kind"), F.lit(None).cast("int").alias("level"), words.alias("text"), words.alias("md"), "region", "header", "rows", "caption", "column")
    both = text.unionByName(table)
    # one document is one ordered whole; its blocks are as few as its pages allow
    return both.select(F.lit(doc).alias("doc"), (F.row_number().over(W.orderBy("page", "at")) - 1).cast("bigint").alias("seq"), "kind", "level", "text", "md", "page", "region", "header", "rows", "caption", "column")


def stitched(blocks: DataFrame) -> DataFrame:
    """Paragraphs that a page or column break cut, as one, and tables that go on beside each other."""
    kept = blocks.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("md", F.coalesce("md", F.lit("")))
    got = B.stitched(kept, ["doc"], ["seq"], "text", ["page", "column"], may=F.col("kind") == "paragraph", also=["md"])
    rest = blocks.select("doc", "seq", "kind", "level", "page", "region", "header", "rows", "caption", F.col("text").isNull().alias("bare"))
    got = got.join(rest, ["doc", "seq"]).select("doc", "seq", "kind", "level", F.when(~F.col("bare"), F.col("text")).alias("text"), F.when(~F.col("bare"), F.col("md")).alias("md"), "page", "region", "header", "rows", "caption")
    tables = got.filter("kind = 'table'")
    return got.filter("kind != 'table'").unionByName(T.side_panels(tables, ["doc"], ["seq"]).select(*got.columns))


def locked(spark: SparkSession, ids: DataFrame, path: str, version: str) -> None:
    """Merges the ids that there are into the lock at path, a local folder: each id's collection, since when it is, and when it went."""
    old = spark.read.parquet(path) if os.path.exists(path) else spark.createDataFrame([], "id string, collection string, since string, retired string")
    new = J.snapshot_diff(old.select("id", "collection", "since", "retired"), ids.select("id", "collection"), "id", "collection", version)
    new.write.mode("overwrite").parquet(f"{path}.next")
    shutil.rmtree(path, ignore_errors=True)
    os.replace(f"{path}.next", path)


def run(spark: SparkSession, step: str, pages: str, out: str, config: dict) -> bool:
    """One step; each reads what the one before stored. True unless validation failed."""
    words = C.Words(**config.get("words", {}))
    book = lambda n: f"{out}/{n}"
    if step == "extract":
        S.read_pages(spark, pages).write.mode("overwrite").parquet(book("pages"))
        S.unknown(S.inventory(S.spans(spark.read.parquet(book("pages")))), rules_of(spark, config)).write.mode("overwrite").parquet(book("unknown"))
    elif step == "blocks":

        def store(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(book(f"work/{name}"))
            return spark.read.parquet(book(f"work/{name}"))

        at = store("blocks", blocks_of(spark.read.parquet(book("pages")), rules_of(spark, config), layout_of(config), store=store))
        stitched(at).write.mode("overwrite").parquet(book("blocks"))
    elif step == "document":
        D.nodes(spark.read.parquet(book("blocks"))).write.mode("overwrite").parquet(book("nodes"))
    elif step == "collect":
        got = C.collect(spark.read.parquet(book("nodes")), words)
        for c in C.COLLECTIONS:
            got[c.name].write.mode("overwrite").parquet(book(f"collections/{c.name}"))
        stored = collections(spark, out)
        links, missing = C.crossrefs(stored, [c.name for c in C.COLLECTIONS])
        links.write.mode("overwrite").parquet(book("links"))
        missing.write.mode("overwrite").parquet(book("unresolved"))
        C.by_id(stored).write.mode("overwrite").parquet(book("by-id"))
        locked(spark, spark.read.parquet(book("by-id")), config.get("lock", book("id-lock")), str(config.get("version", "1")))
    elif step == "export":
        stored = collections(spark, out)
        for c in C.COLLECTIONS:
            sinks.write_collection(stored[c.name], book("json"), c.name, c.index)
        sinks.write_database(sinks.entities(stored), spark.read.parquet(book("links")), book("book.sqlite"))
        sinks.write_schemas(stored, book("schemas"))
        sinks.write_markdown(chapters(spark.read.parquet(book("nodes"))), book("markdown"))
    else:
        text, ok = validate.report("Validation", checks(spark, out, config))
        with open(book("validation.md"), "w", encoding="utf-8") as f:
            f.write(text)
        return ok
    return True


def collections(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    return {c.name: spark.read.parquet(f"{out}/collections/{c.name}") for c in C.COLLECTIONS}


def chapters(nodes: DataFrame) -> DataFrame:
    """(no, slug, text): the Markdown of each chapter; what stands before the first is chapter 0."""
    at = nodes.withColumn("chapter", F.coalesce(F.get("path", F.lit(0)), F.when(F.col("type") == "chapter", F.col("title")), F.lit("")))
    first = at.groupBy("chapter").agg(F.min("pos").alias("first"))
    grid = F.when(F.col("type") == "table", F.concat(F.coalesce(F.concat(F.lit("**"), "caption", F.lit("**\n\n")), F.lit("")), F.concat(F.lit("| "), F.array_join("header", " | "), F.lit(" |\n|"), F.repeat(F.lit("---|"), F.size("header")), F.lit("\n"), F.array_join(F.transform("rows", lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))), "\n"))))
    text = tree.markdown(at.withColumn("md", F.coalesce(grid, "md")), "chapter")
    return text.join(first, "chapter").select((F.row_number().over(W.orderBy("first")) - 1).alias("no"), F.coalesce(F.nullif(slugify(F.col("chapter")), F.lit("")), F.lit("start")).alias("slug"), "text")


def checks(spark: SparkSession, out: str, config: dict) -> DataFrame:
    """Expected against actual: the configured counts, no node without page or title, no unknown style, no id twice."""
    nodes, ids = spark.read.parquet(f"{out}/nodes"), spark.read.parquet(f"{out}/by-id")
    expected = spark.createDataFrame([*config.get("expected", {}).items(), ("nodes without page", 0), ("headings without title", 0), ("unknown styles", 0), ("repeated ids", 0), ("dropped blocks", 0), ("ids not in the lock", 0)], "name string, expected bigint")
    count = lambda df, name: df.agg(F.count("*").alias("actual")).select(F.lit(name).alias("name"), "actual")
    lock = spark.read.parquet(config.get("lock", f"{out}/id-lock"))
    stored = collections(spark, out).values()
    every = reduce(DataFrame.unionByName, [rows.select("id") for rows in stored])
    lost = D.dropped(spark.read.parquet(f"{out}/blocks")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("actual")).select(F.lit("dropped blocks").alias("name"), "actual")
    found = lost.unionByName(count(ids.join(lock.filter("retired is null"), "id", "left_anti"), "ids not in the lock")).unionByName(count(nodes.filter("page is null"), "nodes without page")).unionByName(count(nodes.filter("level is not null and trim(title) = ''"), "headings without title")).unionByName(count(spark.read.parquet(f"{out}/unknown"), "unknown styles")).unionByName(count(validate.duplicate_ids(every), "repeated ids"))
    for name in config.get("expected", {}):
        found = found.unionByName(count(ids.filter(F.col("collection") == name), name))
    return validate.compare(expected, found)


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="quire.build")
    parser.add_argument("step", choices=[*STEPS, "build"])
    parser.add_argument("--pages", default="")
    parser.add_argument("--out", required=True)
    parser.add_argument("--config", required=True)
    got = parser.parse_args(args)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    config, ok = load_config(got.config), True
    os.makedirs(got.out, exist_ok=True)
    for step in STEPS if got.step == "build" else [got.step]:
        ok = run(spark, step, got.pages, got.out, config)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
