"""Queries of page geometry, tables, the tree and collections: orders stand for pages, their lines for what is on them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators import collect as C
from quire.operators import document as D
from quire.operators import layout as L
from quire.operators import tables as T
from quire.operators import validate as V
from quire.plans.base import Plans, table
from quire.sources import sinks

plans = Plans()
LAYOUT = L.Layout()
BOXES = [("table", 0, 50.0, 100.0, 380.0, 200.0), ("table", 1, 200.0, 150.0, 300.0, 300.0), ("sidebar", 0, 280.0, 0.0, 520.0, 400.0)]
BOX_SQL = "boxes(kind, idx, x0, y0, x1, y1) AS (VALUES " + ", ".join(map(str, BOXES)) + ")"
#: An order's lines, numbered from 1; line numbers repeat in the table.
LI = """li0 AS (SELECT l_orderkey, l_linenumber AS k, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY ALL),
    li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY k) AS l_linenumber FROM li0)"""
ROLE_SQL = "CASE l_returnflag WHEN 'A' THEN 'table.header' WHEN 'N' THEN 'body' ELSE 'table.caption' END"


def items(spark, sf_dir):
    names = ("l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    # dealt by order beforehand: least strings are found by sorting, which so is done once, of partitions, not of whole input
    # splits too. By number, since partitions joined by their bytes as shuffled take many times that in the sorts that follow.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = table(spark, sf_dir, "lineitem").repartition(parts, "l_orderkey").groupBy("l_orderkey", F.col("l_linenumber").alias("k")).agg(*[F.min(c).alias(c) for c in names])
    return g.withColumn("l_linenumber", F.row_number().over(W.partitionBy("l_orderkey").orderBy("k")))


def spans(spark, sf_dir):
    """Line items as spans of their orders' pages."""
    role = F.when(F.col("l_returnflag") == "A", "table.header").when(F.col("l_returnflag") == "N", "body").otherwise("table.caption")
    return items(spark, sf_dir).select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("pos"), F.col("l_suppkey").cast("string").alias("t"), F.lit("F").alias("f"), F.lit(9.0).alias("s"), F.lit(0).alias("c"), F.lit(0).alias("fl"),
        (F.col("l_quantity") * 10.0).alias("x"), F.round(F.col("l_extendedprice") / 250, 1).alias("y"), F.lit(None).cast("array<double>").alias("bbox"), role.alias("role"), F.lit(None).cast("int").alias("level"), (F.col("l_linenumber") == 7).alias("discard"),
    )


@plans.add(f"""WITH {LI}, {BOX_SQL}, p AS (SELECT l_orderkey AS page, l_linenumber AS pos, l_quantity * 10.0 AS x, round(l_extendedprice / 250, 1) AS y, {ROLE_SQL} AS role FROM li WHERE l_linenumber <> 7),
    m AS (SELECT page, pos, x, min(struct_pack(idx := idx, w := x1 - x0)) FILTER (kind = 'table' AND role <> 'table.caption' AND x BETWEEN x0 - 4 AND x1 + 4 AND y BETWEEN y0 - 3 AND y1 + 12) AS t1,
      min(struct_pack(idx := idx, w := x1 - x0)) FILTER (kind = 'table' AND role = 'table.header' AND x BETWEEN x0 - 4 AND x1 + 4 AND y0 - y > 0 AND y0 - y <= 60) AS t2, min(idx) FILTER (kind = 'sidebar' AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1) AS sb FROM p CROSS JOIN boxes GROUP BY page, pos, x),
    r AS (SELECT *, coalesce(t1, t2) AS t FROM m) SELECT page, pos, CASE WHEN t IS NOT NULL THEN 'table' || t.idx WHEN sb IS NOT NULL THEN 'sidebar' || sb END AS region, CASE WHEN t.w >= 300 THEN -1 WHEN x < 302 THEN 0 ELSE 1 END AS side FROM r""")
def span_regions(spark, sf_dir):
    """Containment, headers above, priorities, column and full width."""
    of = spans(spark, sf_dir)
    boxes = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("idx"), *[F.lit(v).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), b, strict=True)]) for k, i, *b in BOXES])).alias("b")
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page")).distinct().select("page", boxes).select("page", "b.*")
    return L.placed(of, found, LAYOUT).select("page", "pos", "region", F.col("column").alias("side"))


RECT_SQL = "rects AS (SELECT p_size AS page, p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN 0.2 ELSE 0.9 END AS fill, (p_partkey % 90) * 5.0 AS x0, (p_partkey % 70) * 6.0 AS y0, (p_partkey % 90) * 5.0 + CASE WHEN p_partkey % 3 = 0 THEN 150.0 ELSE 40 + p_partkey % 37 END AS x1, (p_partkey % 70) * 6.0 + CASE WHEN p_partkey % 3 = 0 THEN 160.0 ELSE 30.0 END AS y1 FROM part)"


@plans.add(f"""WITH {RECT_SQL}, kept AS (SELECT a.* FROM rects a WHERE fill = 0.2 OR NOT EXISTS (SELECT 1 FROM rects s WHERE s.fill = 0.2 AND s.page = a.page AND a.x0 + 1 BETWEEN s.x0 - 6 AND s.x1 + 6 AND a.y0 + 1 BETWEEN s.y0 - 6 AND s.y1 + 6 AND a.x1 - 1 BETWEEN s.x0 - 6 AND s.x1 + 6 AND a.y1 - 1 BETWEEN s.y0 - 6 AND s.y1 + 6))
    SELECT page, CASE WHEN fill = 0.2 THEN 'sidebar' ELSE 'table' END AS kind, CAST(row_number() OVER (PARTITION BY page, fill ORDER BY pos) - 1 AS INTEGER) AS idx, CAST(x0 AS DOUBLE) AS x0, CAST(y1 AS DOUBLE) AS y1 FROM kept""")
def anti_containment(spark, sf_dir):
    """Table grounds that aren't inside a sidebar's frame, and the frames, by their fills."""
    side, k = F.col("p_partkey") % 3 == 0, F.col("p_partkey")
    x0, y0 = k % 90 * F.lit(5.0), k % 70 * F.lit(6.0)
    x1, y1 = x0 + F.when(side, F.lit(150.0)).otherwise(40 + k % 37), y0 + F.when(side, 160.0).otherwise(30.0)
    rects = table(spark, sf_dir, "part").select(F.col("p_size").alias("page"), k.alias("pos"), F.array(F.when(side, 0.2).otherwise(0.9)).alias("fill"), x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    return L.regions(rects, LAYOUT).select("page", "kind", "idx", "x0", "y1")


LINE_SQL = "lines AS (SELECT l_orderkey AS page, l_linenumber AS pos, CASE l_linenumber % 3 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE 1 END AS side, l_quantity * 4.0 + l_linenumber / 10.0 AS y, l_linenumber * 1.0 AS x0 FROM li)"


@plans.add(f"""WITH {LI}, {LINE_SQL}, w AS (SELECT *, y - lag(y) OVER (PARTITION BY page ORDER BY y, x0) AS gap FROM lines WHERE side = -1), b AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 40 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY y, x0) AS band FROM w),
    e AS (SELECT page, band, max(y) AS bottom FROM b GROUP BY ALL), s AS (SELECT page, pos, side, y, x0, band * 2 - 1 AS slot FROM b UNION ALL SELECT l.page, l.pos, l.side, l.y, l.x0, 2 * (SELECT count(*) FROM e WHERE e.page = l.page AND e.bottom < l.y) FROM lines l WHERE side >= 0)
    SELECT page, pos, CAST(row_number() OVER (PARTITION BY page ORDER BY slot, CASE WHEN side < 0 THEN NULL ELSE side END, y, x0) - 1 AS INTEGER) AS seq FROM s""")
def reading_order(spark, sf_dir):
    """Columns above, beside and below full-width bands."""
    k = F.col("l_linenumber")
    lines = items(spark, sf_dir).select(F.col("l_orderkey").alias("page"), k.alias("pos"), F.when(k % 3 == 0, -1).when(k % 3 == 1, 0).otherwise(1).alias("column"), (F.col("l_quantity") * 4.0 + k / 10).alias("y"), k.cast("double").alias("x0"))
    return L.reading_order(lines, LAYOUT).select("page", "pos", "seq")


@plans.add(f"""WITH {LI}, s AS (SELECT l_orderkey AS page, CAST(l_suppkey AS VARCHAR) AS t, l_linenumber * 10.0 AS x, l_linenumber * 10.0 + CASE WHEN l_linenumber % 2 = 0 THEN 9.5 ELSE 5.0 END AS x1 FROM li), g AS (SELECT *, x - lag(x1) OVER (PARTITION BY page ORDER BY x) AS gap FROM s)
    SELECT page, string_agg(CASE WHEN gap > 0.9 THEN ' ' ELSE '' END || t, '' ORDER BY x) AS line FROM g GROUP BY page""")
def gap_concat(spark, sf_dir):
    """Spans as a line, a blank where a gap stands for one."""
    k = F.col("l_linenumber")
    part = F.struct((k * 10.0).alias("x"), (k * 10 + F.when(k % 2 == 0, 9.5).otherwise(5.0)).alias("x1"), F.col("l_suppkey").cast("string").alias("t"))
    got = items(spark, sf_dir).groupBy(F.col("l_orderkey").alias("page")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return got.select("page", L.line_text(F.col("parts"), LAYOUT.word_gap).alias("line"))


MARK_SQL = "CASE l_returnflag WHEN 'A' THEN '***' WHEN 'R' THEN '**' ELSE '' END"


@plans.add(f"""WITH {LI}, s AS (SELECT l_orderkey AS page, l_linenumber AS k, CAST(l_suppkey AS VARCHAR) AS t, {MARK_SQL} AS mark FROM li), r AS (SELECT *, CASE WHEN mark IS DISTINCT FROM lag(mark) OVER (PARTITION BY page ORDER BY k) THEN 1 ELSE 0 END AS o FROM s), i AS (SELECT *, sum(o) OVER (PARTITION BY page ORDER BY k) AS run FROM r),
    m AS (SELECT page, run, any_value(mark) AS mark, string_agg(t, ' ' ORDER BY k) AS t FROM i GROUP BY page, run) SELECT page, string_agg(mark || t || mark, ' ' ORDER BY run) AS md FROM m GROUP BY page""")
def emphasis_line(spark, sf_dir):
    """Spans as Markdown, runs of one emphasis marked together."""
    k, flag = F.col("l_linenumber"), F.col("l_returnflag")
    role = F.when(flag == "A", "body.bold-italic").when(flag == "R", "body.bold").otherwise("body")
    part = F.struct((k * 10.0).alias("x"), (k * 10 + 5.0).alias("x1"), F.col("l_suppkey").cast("string").alias("t"), role.alias("role"))
    got = items(spark, sf_dir).groupBy(F.col("l_orderkey").alias("page")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return got.select("page", L.line_markdown(F.col("parts"), LAYOUT).alias("md"))


def cells(spark, sf_dir):
    """Orders as tables of two columns; of every other line the second cell has two lines. Odd orders have their headers beside."""
    k, keyed = F.col("l_linenumber"), F.col("l_orderkey") % 2 == 1
    one = lambda no, t, x, y, role: F.struct(F.lit(no).alias("pos"), t.alias("t"), F.lit(x).alias("x"), y.alias("y"), F.array(F.lit(x), F.lit(0.0), F.lit(x + 30.0), F.lit(0.0)).alias("bbox"), role.alias("role"))
    head, body, y = F.lit("table.header"), F.lit("cell"), k * 100.0
    made = F.array(one(1, F.col("l_returnflag"), 10.0, y, F.when(keyed, head).otherwise(body)), one(2, F.col("l_suppkey").cast("string"), 60.0, y, body))
    made = F.concat(made, F.when(k % 2 == 0, F.array(one(3, F.col("l_linestatus"), 60.0, y + 6, body))).otherwise(F.array().cast("array<struct<pos: int, t: string, x: double, y: double, bbox: array<double>, role: string>>")))
    made = F.concat(made, F.when((k == 1) & ~keyed, F.array(one(4, F.lit("Flag"), 10.0, F.lit(20.0), head), one(5, F.lit("Mode"), 60.0, F.lit(20.0), head))).otherwise(F.array().cast("array<struct<pos: int, t: string, x: double, y: double, bbox: array<double>, role: string>>")))
    return items(spark, sf_dir).select(F.col("l_orderkey").alias("page"), F.lit("table0").alias("region"), F.explode(made).alias("s")).select("page", "region", "s.*")


GRID_SQL = "string_agg(l_returnflag || '|' || CAST(l_suppkey AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN ' ' || l_linestatus ELSE '' END, '/' ORDER BY l_linenumber)"


@plans.add(f"WITH {LI} SELECT l_orderkey AS page, CASE WHEN l_orderkey % 2 = 1 THEN '' ELSE 'Flag|Mode' END AS header, {GRID_SQL} AS rows FROM li GROUP BY l_orderkey")
def table_grids(spark, sf_dir):
    """Orientation, columns by projection, rows by gaps, wrapped cells, headers."""
    got = T.grids(cells(spark, sf_dir))
    return got.select("page", F.array_join("header", "|").alias("header"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/").alias("rows"))


@plans.add(f"WITH {LI} SELECT l_orderkey AS page, {GRID_SQL} AS rows FROM li WHERE l_orderkey % 2 = 1 GROUP BY l_orderkey")
def kv_by_role(spark, sf_dir):
    """Label and value rows, told apart by role."""
    got = T.key_values(cells(spark, sf_dir).filter("page % 2 = 1"))
    return got.select("page", F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/").alias("rows"))


@plans.add("""WITH c(i, x0, x1) AS (VALUES (0, 900.0, 1000.0), (1, 1100.0, 1250.0), (2, 1400.0, 1600.0), (3, 1900.0, 2000.0)) SELECT p_partkey, arg_min(i, struct_pack(d := greatest(x0 - p_retailprice, p_retailprice - x1, 0), i := i)) AS col FROM part CROSS JOIN c GROUP BY p_partkey""")
def nearest_column(spark, sf_dir):
    cols = F.array(*[F.struct(F.lit(a).alias("x0"), F.lit(b).alias("x1")) for a, b in [(900.0, 1000.0), (1100.0, 1250.0), (1400.0, 1600.0), (1900.0, 2000.0)]])
    return table(spark, sf_dir, "part").select("p_partkey", T.nearest(cols, F.col("p_retailprice")).alias("col"))


@plans.add(f"""WITH {LI}, f AS (SELECT l_suppkey AS doc, l_orderkey * 10 + l_linenumber AS seq, l_orderkey // 4000 AS page, CASE WHEN l_linenumber = 1 THEN CAST(l_suppkey AS VARCHAR) END AS caption, l_returnflag AS h, l_linestatus AS v FROM li),
    o AS (SELECT *, CASE WHEN caption IS NULL AND h = lag(h) OVER w AND page = lag(page) OVER w AND h <> 'N' THEN 0 ELSE 1 END AS opens FROM f WINDOW w AS (PARTITION BY doc ORDER BY seq)), r AS (SELECT *, sum(opens) OVER (PARTITION BY doc ORDER BY seq) AS run FROM o)
    SELECT doc, min(seq) AS seq, arg_min(coalesce(caption, ''), seq) AS caption, any_value(CASE WHEN h = 'N' THEN '' ELSE h END) AS header, string_agg(v, '/' ORDER BY seq) AS rows FROM r GROUP BY doc, run""")
def adjacent_merge(spark, sf_dir):
    """Tables that go on beside each other: one header and page, no caption of their own."""
    header = F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(F.array("l_returnflag"))
    found = items(spark, sf_dir).select(F.col("l_suppkey").alias("doc"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.floor(F.col("l_orderkey") / 4000).alias("page"), F.when(F.col("l_linenumber") == 1, F.col("l_suppkey").cast("string")).alias("caption"), header.alias("header"), F.array(F.array("l_linestatus")).alias("rows"))
    got = T.side_panels(found, ["doc"], ["seq"])
    return got.select("doc", "seq", F.coalesce("caption", F.lit("")).alias("caption"), F.array_join("header", "|").alias("header"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/").alias("rows"))


def blocks(spark, sf_dir):
    """Turns of conversations as blocks: a user's opens a stat block, a system's is nothing known."""
    kind = F.when(F.col("role") == "user", "statblock.name").when(F.col("turn") % 5 == 4, "paragraph").when(F.col("turn") % 7 == 6, "odd").otherwise("statblock.body")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("doc"), F.col("turn").cast("bigint").alias("seq"), kind.alias("kind"), F.lit(None).cast("int").alias("level"), "text", F.lit(None).cast("string").alias("md"), F.lit(1).alias("page"), F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("array<string>").alias("header"), F.lit(None).cast("array<array<string>>").alias("rows"), F.lit(None).cast("string").alias("caption"),
    )


KIND_SQL = "CASE WHEN role = 'user' THEN 'statblock.name' WHEN turn % 5 = 4 THEN 'paragraph' WHEN turn % 7 = 6 THEN 'odd' ELSE 'statblock.body' END"
GROUP_SQL = f"""b AS (SELECT CAST(conv_id AS VARCHAR) AS doc, CAST(turn AS BIGINT) AS seq, {KIND_SQL} AS kind, text FROM conversations), m AS (SELECT *, starts_with(kind, 'statblock') AS s, lag(starts_with(kind, 'statblock')) OVER (PARTITION BY doc ORDER BY seq) AS before FROM b),
    o AS (SELECT *, max(CASE WHEN s AND (before IS DISTINCT FROM true OR kind = 'statblock.name') THEN seq END) OVER (PARTITION BY doc ORDER BY seq) AS g FROM m), r AS (SELECT o.*, f.kind AS first FROM o LEFT JOIN b f ON f.doc = o.doc AND f.seq = o.g),
    k AS (SELECT doc, seq, kind, text, CASE WHEN s AND first = 'statblock.name' THEN g END AS gseq FROM r)"""


@plans.add(f"WITH {GROUP_SQL} SELECT doc, seq, gseq FROM k")
def block_groups(spark, sf_dir):
    """Stat blocks take what follows their name."""
    return D.grouped(blocks(spark, sf_dir)).select("doc", "seq", "gseq")


@plans.add(f"WITH {GROUP_SQL} SELECT kind, count(*) AS n FROM k WHERE gseq IS NULL AND kind NOT IN ('paragraph', 'statblock.name') AND trim(text) <> '' GROUP BY kind")
def dropped_blocks(spark, sf_dir):
    return D.dropped(blocks(spark, sf_dir))


@plans.add(f"""WITH {GROUP_SQL} SELECT doc, gseq AS pos, 'statblock' AS type, text AS title, NULL AS parent_pos FROM k WHERE kind = 'statblock.name' UNION ALL SELECT doc, seq, 'paragraph', NULL, gseq FROM k WHERE kind = 'statblock.body' AND gseq IS NOT NULL UNION ALL SELECT doc, seq, 'paragraph', NULL, NULL FROM k WHERE kind = 'paragraph'""")
def document_nodes(spark, sf_dir):
    """Nodes with their parents: stat blocks, their parts and what stands by itself."""
    n = D.nodes(blocks(spark, sf_dir))
    p = n.select(F.col("doc"), F.col("node_id").alias("parent_id"), F.col("pos").alias("parent_pos"))
    return n.join(p, ["doc", "parent_id"], "left").select("doc", "pos", "type", "title", "parent_pos")


def records(spark, sf_dir, prefix="part", shift=0):
    at = table(spark, sf_dir, "part")
    return at.select(F.concat(F.lit(prefix + "."), (F.col("p_partkey") % 700 + shift).cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("size"), F.col("p_type").alias("text"), F.struct(F.col("p_size").alias("page")).alias("source"))


@plans.add("""SELECT 'part.' || (p_partkey % 700) AS id, p_name AS name, CASE WHEN p_size > 25 THEN p_size END AS size, p_size AS page FROM part""")
def index_projection(spark, sf_dir):
    return C.index_of(records(spark, sf_dir), ("id", "name", "size", "not there"))


LAST_SQL = "r AS (SELECT 'a' AS collection, 0 AS k, 'part.' || (p_partkey % 700) AS id, p_name AS name, p_size AS page, p_partkey AS pos, p_type AS text FROM part UNION ALL SELECT 'b', 1, 'part.' || (p_partkey % 700 + 350), p_name, p_size, p_partkey, p_type FROM part), l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC, pos DESC) AS n FROM r)"


@plans.add(f"WITH {LAST_SQL} SELECT id, collection, name, page, collection || '/' || split_part(id, '.', 2) || '.json' AS path, pos FROM l WHERE n = 1")
def by_id_index(spark, sf_dir):
    """Of records with one id the last counts."""
    return C.by_id({"a": records(spark, sf_dir), "b": records(spark, sf_dir, shift=350)})


@plans.add(f"WITH {LAST_SQL} SELECT page, string_agg(id, ',' ORDER BY collection, pos, id) AS ids FROM l WHERE n = 1 GROUP BY page")
def by_page_index(spark, sf_dir):
    got = C.by_page(C.by_id({"a": records(spark, sf_dir), "b": records(spark, sf_dir, shift=350)}))
    return got.select("page", F.array_join("ids", ",").alias("ids"))


@plans.add(f"WITH {LAST_SQL} SELECT id, collection, page, text || chr(10) AS body FROM l WHERE n = 1")
def searchable_text(spark, sf_dir):
    """All text of a record, of one id the last."""
    return sinks.entities({"a": records(spark, sf_dir), "b": records(spark, sf_dir, shift=350)}).select("id", "collection", "page", "body")


@plans.add(f"WITH {LAST_SQL} SELECT id, name, page FROM l WHERE n = 1 AND id IN ('part.5', 'part.399', 'part.1049', 'part.none')")
def keyed_lookup(spark, sf_dir):
    got = C.by_id({"a": records(spark, sf_dir), "b": records(spark, sf_dir, shift=350)})
    return got.filter(F.col("id").isin("part.5", "part.399", "part.1049", "part.none")).select("id", "name", "page")


@plans.add(r"""WITH b AS (SELECT p_partkey AS pos, 'item.' || trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS b FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY pos) AS k FROM b) SELECT pos, b || CASE WHEN k > 1 THEN '-' || k ELSE '' END AS id FROM n""")
def record_ids(spark, sf_dir):
    """Ids of records by prefix, name and occurrence."""
    return C.with_ids(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_type").alias("name")), "item").select("pos", "id")


@plans.add("SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey % 11 <> 0 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)")
def subset_assertion(spark, sf_dir):
    """Keys that should be among others and aren't."""
    some = table(spark, sf_dir, "lineitem").filter("l_partkey % 11 <> 0").select(F.col("l_partkey").alias("key"))
    return V.missing(some, table(spark, sf_dir, "part").filter("p_size > 2").select(F.col("p_partkey").alias("key")), "key")


@plans.add("SELECT count(*) AS n, count(*) FILTER (WHERE c = e) AS passed, count(*) FILTER (WHERE c <> e) = 0 AS ok FROM (SELECT n_nationkey, count(c_custkey) AS c, any_value(CASE WHEN n_nationkey = 3 THEN -1 ELSE (SELECT count(*) FROM customer x WHERE x.c_nationkey = n_nationkey) END) AS e FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey)")
def verdict(spark, sf_dir):
    """Expected counts against actual ones, and whether all hold."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    actual = n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy(F.col("n_name").alias("name")).agg(F.count("c_custkey").alias("actual"))
    expected = n.join(c.groupBy("c_nationkey").agg(F.count("*").alias("k")), F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") == 3, -1).otherwise(F.coalesce("k", F.lit(0))).cast("bigint").alias("expected"))
    return V.verdict(V.compare(expected, actual)).toDF("n", "passed", "ok")
