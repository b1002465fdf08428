"""From spans to lines: roles, regions, baselines, superscripts and reading order. Joins are by page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators.joins import contains
from quire.sources import pages as S

RULES = "ord int, role string, font string, size double, color int, level int, discard boolean"


@dataclass(frozen=True)
class Layout:
    """A publication's geometry and fills."""

    column_split: float = 302.0
    full_width: float = 300.0
    sidebar_fills: tuple[float, ...] = (0.2,)
    table_fills: tuple[float, ...] = (0.9,)
    fill_tolerance: float = 0.02
    size_tolerance: float = 0.2
    header_reach: float = 60.0
    pair_gap: float = 12.0
    superscript_rise: float = 5.0
    band_gap: float = 40.0
    word_gap: float = 0.9
    strong_em: tuple[str, ...] = ("body.bold-italic",)
    strong: tuple[str, ...] = ("body.bold",)
    em: tuple[str, ...] = ("body.italic",)


def with_roles(spans: DataFrame, rules: DataFrame, layout: Layout) -> DataFrame:
    """Spans with role, level and discard of the first rule that fits; without a rule these are null."""
    r = rules.select("ord", "role", F.col("font").alias("f"), F.col("size").alias("r_s"), F.col("color").alias("c"), "level", "discard")
    # font and colour are equalities, so this is a hash join; sizes within tolerance leave few rows
    met = spans.join(r, ["f", "c"], "left").withColumn("fits", F.abs(F.col("s") - F.col("r_s")) <= layout.size_tolerance)
    best = F.min_by(F.when(F.col("fits"), F.struct("role", "level", "discard")), F.when(F.col("fits"), F.col("ord")))
    return met.groupBy("page", "pos", "t", "f", "s", "c", "fl", "x", "y", "bbox").agg(best.alias("r")).select("page", "pos", "t", "f", "s", "c", "fl", "x", "y", "bbox", "r.role", "r.level", F.coalesce("r.discard", F.lit(False)).alias("discard"))


def fill_is(fill: Column, targets: tuple[float, ...], tolerance: float) -> Column:
    return F.exists(F.array(*map(F.lit, targets)), lambda t: F.abs(F.get(fill, F.lit(0)) - t) <= tolerance)


def regions(rects: DataFrame, layout: Layout) -> DataFrame:
    """(page, kind, idx, x0, y0, x1, y1): frames of sidebars, and table grounds that aren't inside one."""
    box = ["x0", "y0", "x1", "y1"]
    side = rects.filter(fill_is(F.col("fill"), layout.sidebar_fills, layout.fill_tolerance) & (F.col("x1") - F.col("x0") > 50))
    ground = rects.filter(fill_is(F.col("fill"), layout.table_fills, layout.fill_tolerance))
    s = side.select(F.col("page").alias("s_page"), *[F.col(c).alias(f"s_{c}") for c in box])
    frame = {c: F.col(f"s_{c}") for c in box}
    inside = (F.col("page") == F.col("s_page")) & contains(F.col("x0") + 1, F.col("y0") + 1, frame, 6) & contains(F.col("x1") - 1, F.col("y1") - 1, frame, 6)
    free = ground.join(s, inside, "left_anti")
    number = (F.row_number().over(W.partitionBy("page").orderBy("pos")) - 1).alias("idx")
    return side.select("page", F.lit("sidebar").alias("kind"), number, *box).unionByName(free.select("page", F.lit("table").alias("kind"), number, *box))


def placed(spans: DataFrame, found: DataFrame, layout: Layout) -> DataFrame:
    """Spans that stay, with region (table before sidebar) and column (-1 over the full width)."""
    spans = spans.filter(~F.col("discard"))
    aside = F.coalesce((F.col("role") == "table.caption") | F.col("role").startswith("statblock.ability"), F.lit(False))
    x, y = F.col("x"), F.col("y")
    table = lambda b: b["kind"] == "table"
    within = lambda b: table(b) & ~aside & contains(x, y, b, 4, 3, 12)
    above = lambda b: table(b) & (F.col("role") == "table.header") & x.between(b["x0"] - 4, b["x1"] + 4) & (b["y0"] - y > 0) & (b["y0"] - y <= layout.header_reach)
    boxed = lambda b: (b["kind"] == "sidebar") & contains(x, y, b)
    # a page's regions come as one array, so that each span stays one row and none has to be put together again
    at = spans.join(found.groupBy("page").agg(F.collect_list(F.struct("kind", "idx", "x0", "y0", "x1", "y1")).alias("boxes")), "page", "left")
    least = lambda cond, take: F.array_min(F.transform(F.filter("boxes", cond), take))
    wide = lambda b: F.struct(b["idx"].alias("idx"), (b["x1"] - b["x0"]).alias("w"))
    keys = [c for c in spans.columns]
    got = at.select(*keys, least(within, wide).alias("t1"), least(above, wide).alias("t2"), least(boxed, lambda b: b["idx"]).alias("sb"))
    t = F.coalesce("t1", "t2")
    region = F.when(t.isNotNull(), F.concat(F.lit("table"), t["idx"].cast("string"))).when(F.col("sb").isNotNull(), F.concat(F.lit("sidebar"), F.col("sb").cast("string")))
    column = F.when(t["w"] >= layout.full_width, -1).when(x < layout.column_split, 0).otherwise(1)
    return got.select(*keys, region.alias("region"), column.alias("column"))


def line_text(parts: Column, word_gap: float) -> Column:
    """Spans (x, x1, t) of a line as text; a blank where a gap stands for one."""
    step = lambda acc, p: F.struct(F.concat(acc["out"], F.when((acc["out"] != "") & (p["x"] - acc["end"] > word_gap) & ~acc["out"].rlike("[\\s­]$") & ~p["t"].rlike("^\\s"), " ").otherwise(""), p["t"]).alias("out"), F.coalesce(p["x1"], p["x"]).cast("double").alias("end"))
    return F.aggregate(parts, F.struct(F.lit("").alias("out"), F.lit(0.0).alias("end")), step, lambda acc: acc["out"])


def emphasis(role: Column, layout: Layout) -> Column:
    """The Markdown mark of a role: the first set that has it counts."""
    return F.when(role.isin(*layout.strong_em), "***").when(role.isin(*layout.strong), "**").when(role.isin(*layout.em), "*").otherwise("")


def line_markdown(parts: Column, layout: Layout) -> Column:
    """Spans of a line as Markdown: runs of one emphasis are marked together, blanks stay outside the marks."""

    def closed(acc):
        bare = F.trim(acc["run"])
        lead = F.regexp_extract(acc["run"], r"^(\s*)", 1)
        tail = F.regexp_extract(acc["run"], r"(\s*)$", 1)
        return F.concat(acc["out"], F.when((acc["mark"] == "") | (bare == ""), acc["run"]).otherwise(F.concat(lead, acc["mark"], bare, acc["mark"], tail)))

    def step(acc, p):
        mark = emphasis(F.coalesce(p["role"], F.lit("")), layout)
        gap = (p["x"] - acc["end"] > layout.word_gap) & (acc["end"] >= 0) & ~acc["run"].rlike("[\\s­]$") & ~p["t"].rlike("^\\s")
        text = F.concat(F.when(gap, " ").otherwise(""), p["t"])
        end = F.coalesce(p["x1"], p["x"]).cast("double")
        return F.when(mark == acc["mark"], F.struct(acc["out"].alias("out"), acc["mark"].alias("mark"), F.concat(acc["run"], text).alias("run"), end.alias("end"))).otherwise(F.struct(closed(acc).alias("out"), mark.alias("mark"), text.alias("run"), end.alias("end")))

    start = F.struct(F.lit("").alias("out"), F.lit("").alias("mark"), F.lit("").alias("run"), F.lit(-1.0).alias("end"))
    return F.trim(F.regexp_replace(F.aggregate(parts, start, step, closed), r"\s+", " "))


def lines(of: DataFrame, layout: Layout) -> DataFrame:
    """Spans on one baseline of a region and column as a line; halves near each other and superscripts are merged into theirs.

    The dominant role has the most characters, the first seen on ties.
    """
    part = F.struct("x", "pos", F.coalesce(F.get("bbox", F.lit(2)), F.col("x")).alias("x1"), "t", "role", "s", "level")
    base = of.withColumn("tenth", F.bround(F.col("y") * 10).cast("int"))
    got = base.groupBy("page", F.coalesce("region", F.lit("")).alias("region"), "column", "tenth").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("s").alias("size"))
    got = got.select("*", F.array_min(F.transform("parts", lambda p: p["x"])).alias("x0"), F.array_max(F.transform("parts", lambda p: p["x1"])).alias("x1"), (F.col("tenth") / 10).alias("y"))
    got = _raised(_halves(got, layout), layout)
    spread = got.select("page", "region", "column", "tenth", F.explode("parts").alias("p"))
    weight = spread.groupBy("page", "region", "column", "tenth", F.col("p.role").alias("role")).agg(F.sum(F.length("p.t")).alias("w"), F.min(F.struct("p.x", "p.pos")).alias("first"), F.first("p.level").alias("level"))
    role = weight.groupBy("page", "region", "column", "tenth").agg(F.min_by(F.struct("role", "level"), F.struct((-F.col("w")).alias("w"), "first")).alias("r"))
    return got.join(role, ["page", "region", "column", "tenth"]).select("page", F.nullif("region", F.lit("")).alias("region"), "column", "y", "x0", "x1", "size", "r.role", "r.level", line_text(F.col("parts"), layout.word_gap).alias("text"), line_markdown(F.col("parts"), layout).alias("md"), "parts")


def _halves(got: DataFrame, layout: Layout) -> DataFrame:
    """Lines of both columns on one baseline, with hardly a gap, are one that crosses the gutter."""
    w = W.partitionBy("page", "region", "tenth").orderBy("x0")
    nxt = F.lead(F.struct("x0", "x1", "parts", "column", "size")).over(w)
    prev = F.lag(F.struct("x1", "column")).over(w)
    joins = lambda a, b: (a["column"] == 0) & (b["column"] == 1) & (b["x0"] - a["x1"] <= layout.pair_gap)
    me = F.struct("x0", "x1", "column")
    at = got.select("*", nxt.alias("nxt"), F.coalesce((prev["column"] == 0) & (F.col("column") == 1) & (F.col("x0") - prev["x1"] <= layout.pair_gap), F.lit(False)).alias("taken"))
    take = F.coalesce(joins(me, F.col("nxt")), F.lit(False))
    at = at.filter(~F.col("taken")).withColumn("take", take)
    return at.select("page", "region", "column", "tenth", F.when(F.col("take"), F.concat("parts", "nxt.parts")).otherwise(F.col("parts")).alias("parts"), F.when(F.col("take"), F.greatest("size", "nxt.size")).otherwise(F.col("size")).alias("size"), "x0", F.when(F.col("take"), F.col("nxt.x1")).otherwise(F.col("x1")).alias("x1"), "y")


def _raised(got: DataFrame, layout: Layout) -> DataFrame:
    """A line of superscript spans goes into the nearest line below it, within superscript_rise, of its column and region."""
    small = F.forall("parts", lambda p: F.coalesce(p["role"].endswith("superscript"), F.lit(False)))
    key = ["page", "region", "column"]
    sup = got.filter(small).select(*key, F.col("tenth").alias("s_tenth"), F.col("y").alias("s_y"), F.col("parts").alias("s_parts"))
    host = got.filter(~small)
    near = (F.col("y") - F.col("s_y") >= 0) & (F.col("y") - F.col("s_y") <= layout.superscript_rise)
    pairs = sup.join(host.select(*key, "tenth", "y"), key).filter(near)
    best = pairs.groupBy(*key, "s_tenth").agg(F.min_by("tenth", F.struct((F.col("y") - F.col("s_y")).alias("d"), "tenth")).alias("tenth"), F.first("s_parts").alias("s_parts"))
    extra = best.groupBy(*key, "tenth").agg(F.flatten(F.collect_list("s_parts")).alias("extra"))
    orphan = got.filter(small).join(best.select(*key, F.col("s_tenth").alias("tenth")), [*key, "tenth"], "left_anti")
    merged = host.join(extra, [*key, "tenth"], "left").withColumn("parts", F.array_sort(F.concat("parts", F.coalesce("extra", F.array().cast(got.schema["parts"].dataType))))).drop("extra")
    return merged.unionByName(orphan)


def reading_order(of: DataFrame, layout: Layout) -> DataFrame:
    """Lines with seq, from 0 on each page: what stands above a full-width band by column, then the band, and so on.

    Bands are chains of full-width lines no more than band_gap apart. A line beside a band, not part of
    it, is read with what comes before the band's end: none is lost.
    """
    wide = F.coalesce(F.col("column") == -1, F.lit(False))
    w = W.partitionBy("page").orderBy(~wide, "y", "x0")
    at = of.withColumn("opens", wide & (F.lag("y").over(w).isNull() | (F.col("y") - F.lag("y").over(w) > layout.band_gap)))
    at = at.withColumn("band", F.when(wide, F.sum(F.col("opens").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))))
    at = at.withColumn("closes", wide & F.coalesce(F.lead(F.col("opens") | ~wide).over(w), F.lit(True)))
    # other lines come after the bands that end above them: at one height the band's last line is counted later
    above = W.partitionBy("page").orderBy("y", "closes").rowsBetween(W.unboundedPreceding, 0)
    slots = at.withColumn("before", F.sum(F.col("closes").cast("int")).over(above))
    slot = F.when(F.col("band").isNotNull(), F.col("band") * 2 - 1).otherwise(F.col("before") * 2)
    ordered = W.partitionBy("page").orderBy(slot, F.when(F.col("band").isNull(), F.col("column")), "y", "x0")
    return slots.withColumn("seq", F.row_number().over(ordered) - 1).drop("opens", "closes", "before")


def page_lines(pages: DataFrame, rules: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Lines of raw pages in reading order."""
    layout = layout or Layout()
    found = regions(S.rects(pages), layout)
    at = placed(with_roles(S.spans(pages), rules, layout), found, layout)
    return reading_order(lines(at, layout), layout)
