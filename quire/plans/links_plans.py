"""Queries of joins, lookups, filters and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import joins as J
from quire.plans.base import Plans, table

plans = Plans()
LINK = r'<a href="/([^"]*)">'
MENTIONS = r"""m AS (SELECT page_id, i AS pos, trim(regexp_replace(lower(strip_accents(l[i])), '[^a-z0-9]+', '-', 'g'), '-') AS slug
    FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)">', 1) AS l FROM pages)))"""
NAMES = r"""names AS (SELECT slug, min(page_id) AS target FROM (SELECT page_id, trim(regexp_replace(lower(strip_accents(split_part(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ' ', 1))), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages) WHERE slug <> '' GROUP BY slug)"""
LINKS = f"""{MENTIONS}, {NAMES}, links AS (SELECT page_id AS source, target, min(pos) AS pos FROM m JOIN names USING (slug) WHERE page_id <> target GROUP BY ALL)"""


def mentions(spark, sf_dir):
    links = F.posexplode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", links).select(F.col("page_id").alias("source"), (F.col("pos") + 1).cast("bigint").alias("pos"), X.slugify(F.col("col")).alias("slug"))


def names(spark, sf_dir):
    title = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    return table(spark, sf_dir, "pages").select(X.slugify(F.split_part(title, F.lit(" "), F.lit(1))).alias("slug"), F.col("page_id").alias("target")).filter("slug <> ''")


def links(spark, sf_dir):
    return J.resolve(mentions(spark, sf_dir), names(spark, sf_dir), "slug", "source", "target", ["target"])


@plans.add(f"WITH {LINKS} SELECT source, target, pos FROM links")
def crossref_links(spark, sf_dir):
    return links(spark, sf_dir)


@plans.add(f"WITH {LINKS} SELECT target, string_agg(CAST(source AS VARCHAR), ',' ORDER BY source) AS sources, count(*) AS n FROM links GROUP BY target")
def incoming_refs(spark, sf_dir):
    return J.incoming(links(spark, sf_dir), "source", "target").withColumn("sources", F.array_join(F.transform("sources", lambda x: x.cast("string")), ","))


@plans.add(f"WITH {LINKS} SELECT target, count(*) AS n FROM links GROUP BY target ORDER BY n DESC, target LIMIT 20")
def top_referenced(spark, sf_dir):
    return J.incoming(links(spark, sf_dir), "source", "target").select("target", "n").orderBy(F.desc("n"), "target").limit(20)


@plans.add(f"WITH {MENTIONS}, {NAMES} SELECT slug, count(*) AS n FROM m WHERE slug NOT IN (SELECT slug FROM names) GROUP BY slug ORDER BY n DESC, slug LIMIT 200")
def unresolved_refs(spark, sf_dir):
    return J.unresolved(mentions(spark, sf_dir), names(spark, sf_dir), "slug")


#: Rules on parts: order, type, size, role, level, whether such rows go.
RULES = [(1, "PROMO", 10, "title", 1, False), (2, "PROMO", 12, "heading", 2, False), (3, "SMALL", 5, "running-head", None, True), (4, "SMALL", 30, "cell", None, False), (5, "MEDIUM", 20, "body", None, False), (6, "ECONOMY", 7, "page-number", None, True)]
RULE_COLUMNS = "ord int, r_type string, r_size int, role string, level int, discard boolean"
RULE_SQL = "rules(ord, r_type, r_size, role, level, discard) AS (VALUES " + ", ".join(f"({o}, '{t}', {s}, '{r}', {'NULL' if v is None else v}, {str(d).lower()})" for o, t, s, r, v, d in RULES) + ")"
FITS = "p_type LIKE '%' || r_type || '%' AND abs(p_size - r_size) <= 2"


def matched(spark, sf_dir):
    rules = spark.createDataFrame(RULES, RULE_COLUMNS)
    fits = F.col("p_type").contains(F.col("r_type")) & (F.abs(F.col("p_size") - F.col("r_size")) <= 2)
    return J.first_match(table(spark, sf_dir, "part"), rules, fits, ["p_partkey"], "ord", ["role", "level", "discard"])


MATCHED = f"{RULE_SQL}, matched AS (SELECT p_partkey, arg_min(role, ord) AS role, min(ord) AS o FROM part LEFT JOIN rules ON {FITS} GROUP BY p_partkey), full_m AS (SELECT p_partkey, r.role, r.level, r.discard FROM matched LEFT JOIN rules r ON r.ord = matched.o)"


@plans.add(f"WITH {MATCHED} SELECT p_partkey, role, level FROM full_m")
def rule_match_first(spark, sf_dir):
    return matched(spark, sf_dir).select("p_partkey", "role", "level")


@plans.add(f"WITH {MATCHED} SELECT p_partkey, coalesce(role, 'none') AS role FROM full_m WHERE NOT coalesce(discard, false)")
def discard_filter(spark, sf_dir):
    return matched(spark, sf_dir).filter(~F.coalesce("discard", F.lit(False))).select("p_partkey", F.coalesce("role", F.lit("none")).alias("role"))


@plans.add("SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL")
def style_inventory(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_type", "p_size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand", "p_type", "p_size")


@plans.add(f"WITH {MATCHED} SELECT p_type, p_size, count(*) AS n FROM full_m JOIN part USING (p_partkey) WHERE role IS NULL GROUP BY ALL")
def unknown_styles(spark, sf_dir):
    rules = spark.createDataFrame(RULES, RULE_COLUMNS)
    part = table(spark, sf_dir, "part").groupBy("p_type", "p_size").agg(F.count("*").alias("n"))
    return part.join(rules, F.col("p_type").contains(F.col("r_type")) & (F.abs(F.col("p_size") - F.col("r_size")) <= 2), "left_anti")


#: Boxes: number, kind, left, top, right, bottom.
BOXES = [(0, "table", 0.0, 0.0, 90.0, 150000.0), (1, "table", 60.0, 50000.0, 200.0, 260000.0), (2, "sidebar", 150.0, 0.0, 300.0, 400000.0), (3, "sidebar", 155.0, 10000.0, 290.0, 300000.0)]
BOX_COLUMNS = "idx int, kind string, x0 double, y0 double, x1 double, y1 double"
BOX_SQL = "boxes(idx, kind, x0, y0, x1, y1) AS (VALUES " + ", ".join(map(str, BOXES)) + ")"


@plans.add(f"""WITH {BOX_SQL}, p AS (SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS DOUBLE) AS x, o_totalprice AS y FROM orders),
    t AS (SELECT o_orderkey, min(idx) FILTER (kind = 'table') AS t, min(idx) FILTER (kind = 'sidebar') AS s FROM p LEFT JOIN boxes ON x BETWEEN x0 - 4 AND x1 + 4 AND y BETWEEN y0 - 3 AND y1 + 12 GROUP BY o_orderkey)
    SELECT o_orderkey, coalesce(t, s) AS box FROM t""")
def region_first_match(spark, sf_dir):
    boxes = spark.createDataFrame(BOXES, BOX_COLUMNS)
    points = table(spark, sf_dir, "orders").select("o_orderkey", F.dayofyear("o_orderdate").cast("double").alias("x"), F.col("o_totalprice").alias("y"))
    within = J.contains(F.col("x"), F.col("y"), {c: F.col(c) for c in ("x0", "y0", "x1", "y1")}, 4, 3, 12)
    met = points.join(boxes, within, "left").groupBy("o_orderkey")
    got = met.agg(F.min(F.when(F.col("kind") == "table", F.col("idx"))).alias("t"), F.min(F.when(F.col("kind") == "sidebar", F.col("idx"))).alias("s"))
    return got.select("o_orderkey", F.coalesce("t", "s").alias("box"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("at", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint"))


@plans.add("""SELECT p.event_id, (SELECT v.event_id FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts < p.ts AND epoch_ms(p.ts) - epoch_ms(v.ts) <= 3600000 ORDER BY v.ts DESC, v.event_id DESC LIMIT 1) AS near_event_id
    FROM events p WHERE p.event_type = 'purchase'""")
def nearest_above(spark, sf_dir):
    e = _events(spark, sf_dir)
    got = J.as_of(e.filter("event_type = 'purchase'").select("event_id", "user_id", "at"), e.filter("event_type = 'view'").select("event_id", "user_id", "at"), ["user_id"], "at", 3_600_000, ["event_id"])
    return got.select("event_id", "near_event_id")


@plans.add("""SELECT p.event_id, (SELECT v.event_id FROM events v WHERE v.user_id = p.user_id AND v.ts > p.ts AND epoch_ms(v.ts) - epoch_ms(p.ts) <= 300000 ORDER BY v.ts, v.event_id DESC LIMIT 1) AS near_event_id
    FROM events p WHERE p.event_type = 'error'""")
def nearest_host(spark, sf_dir):
    e = _events(spark, sf_dir)
    got = J.as_of(e.filter("event_type = 'error'").select("event_id", "user_id", "at"), e.select("event_id", "user_id", "at"), ["user_id"], "at", 300_000, ["event_id"], forward=True)
    return got.select("event_id", "near_event_id")


@plans.add("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS k, date_trunc('hour', ts) AS h FROM events)
    SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id FROM n a JOIN n b ON a.user_id = b.user_id AND a.h = b.h AND a.k = 1 AND b.k = 2 WHERE epoch_ms(b.ts) - epoch_ms(a.ts) <= 720000""")
def pair_merge(spark, sf_dir):
    w = W.partitionBy("user_id", F.date_trunc("hour", "ts")).orderBy("ts", "event_id")
    e = _events(spark, sf_dir).select("*", F.row_number().over(w).alias("k"), F.lead("event_id").over(w).alias("second_id"), F.lead("at").over(w).alias("next"))
    return e.filter((F.col("k") == 1) & (F.col("next") - F.col("at") <= 720_000)).select("user_id", F.col("event_id").alias("first_id"), "second_id")


@plans.add(r"""WITH s AS (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, min(p_partkey) AS part FROM part GROUP BY 1)
    SELECT l_orderkey, l_linenumber, s.part FROM lineitem JOIN part ON l_partkey = p_partkey JOIN s ON s.slug = trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-')""")
def slug_lookup_first(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", X.slugify(X.without_parens(F.concat("p_name", F.lit(" (x)")))).alias("slug"))
    first = J.names_first(part.select("slug", F.col("p_partkey").alias("part")), "slug", ["part"])
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).join(first, "slug").select("l_orderkey", "l_linenumber", "part")


@plans.add("""WITH p(k, pre, label) AS (VALUES (1, '1', 'top'), (2, '1-URGENT', 'never'), (3, '2', 'high'), (4, '4', 'none')), o AS (SELECT DISTINCT o_orderpriority AS q FROM orders),
    f AS (SELECT q, arg_min(label, k) AS label FROM o LEFT JOIN p ON starts_with(q, pre) GROUP BY q) SELECT o_orderkey, label FROM orders JOIN f ON q = o_orderpriority""")
def prefix_lookup(spark, sf_dir):
    p = spark.createDataFrame([(1, "1", "top"), (2, "1-URGENT", "never"), (3, "2", "high"), (4, "4", "none")], "k int, pre string, label string")
    orders = table(spark, sf_dir, "orders")
    kinds = orders.select("o_orderpriority").distinct()
    found = J.first_match(kinds, p, F.col("o_orderpriority").startswith(F.col("pre")), ["o_orderpriority"], "k", ["label"])
    return orders.join(found, "o_orderpriority").select("o_orderkey", "label")


@plans.add("""SELECT a.conv_id, a.turn, bool_or(b.turn = a.turn) AS here, bool_or(b.turn = a.turn + 1 AND contains(b.text, split_part(a.text, ' ', 1))) AS on_next
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn IN (a.turn, a.turn + 1) GROUP BY a.conv_id, a.turn""")
def neighbour_page(spark, sf_dir):
    a = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split_part("text", F.lit(" "), F.lit(1)).alias("word"), F.explode(F.array(F.col("turn"), F.col("turn") + 1)).alias("t"))
    b = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("t"), F.col("text").alias("other"))
    got = a.join(b, ["conv_id", "t"]).groupBy("conv_id", "turn")
    return got.agg(F.bool_or(F.col("t") == F.col("turn")).alias("here"), F.bool_or((F.col("t") == F.col("turn") + 1) & F.col("other").contains(F.col("word"))).alias("on_next"))


@plans.add("""WITH o AS (SELECT o_custkey AS id, max(o_orderstatus) AS place FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1), n AS (SELECT o_custkey AS id, max(o_orderstatus) AS place FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1),
    j AS (SELECT o.id AS oi, n.id AS ni, o.place AS op, n.place AS np, o.id % 7 = 0 AS gone FROM o FULL JOIN n ON o.id = n.id),
    s AS (SELECT *, CASE WHEN ni IS NULL THEN 'retired' WHEN oi IS NULL THEN 'added' WHEN gone THEN 'returned' WHEN op IS NOT DISTINCT FROM np THEN 'kept' ELSE 'moved' END AS status FROM j)
    SELECT coalesce(ni, oi) AS id, coalesce(np, op) AS place, status, CASE WHEN oi IS NULL THEN '2' ELSE '1' END AS since, CASE WHEN status = 'moved' THEN op END AS moved_from, CASE WHEN status = 'retired' THEN CASE WHEN gone THEN '1.5' ELSE '2' END END AS retired FROM s""")
def snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    at = lambda cond: o.filter(cond).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderstatus").alias("place"))
    old = at("o_orderdate < timestamp_ntz'1996-01-01'").select("*", F.lit("1").alias("since"), F.when(F.col("id") % 7 == 0, "1.5").alias("retired"))
    return J.snapshot_diff(old, at("o_orderdate >= timestamp_ntz'1996-01-01'"), "id", "place", "2")


@plans.add("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def provenance_check(spark, sf_dir):
    """Items found literally. Words 2 to 4 of an item of five words or more are whole words of a text that has it, and meet by equality; then the whole is looked for. Shorter items are looked for in every text."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    b = b.select("*", F.split(F.col("item"), "\\s").alias("w")).select("item_id", "item", F.array_join(F.slice("w", 2, 3), " ").alias("key"), (F.size("w") < 5).alias("short"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.split("text", "\\s").alias("w"))
    keys = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 2, F.lit(1))), lambda i: F.array_join(F.slice("w", i, 3), " "))))
    long = docs.select("doc_id", "text", keys.alias("key")).join(b.filter(~F.col("short")), "key").filter(F.col("text").contains(F.col("item"))).select("doc_id", "item_id")
    few = F.broadcast(b.filter("short").select("item_id", "item"))
    return long.unionByName(docs.join(few, F.col("text").contains(F.col("item"))).select("doc_id", "item_id")).distinct()


@plans.add("SELECT event_id FROM events WHERE event_type IN ('view', 'click') AND value >= 20 AND json_extract_string(props, '$.k') IS NOT NULL")
def index_filter(spark, sf_dir):
    from quire.operators.search import facets

    e = table(spark, sf_dir, "events")
    return facets(e, {"event_type": ["view", "click"], "user_id": None}, {"value": 20.0}).filter(F.get_json_object("props", "$.k").isNotNull()).select("event_id")


@plans.add("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 20")
def json_path_filter(spark, sf_dir):
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k")).filter("k >= 20")


@plans.add("SELECT 'part' AS kind, p_partkey AS id, p_name AS name, p_size AS size FROM part UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def union_sources(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@plans.add("(SELECT DISTINCT o_custkey AS id, 'only_f' AS side FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')) UNION ALL (SELECT DISTINCT o_custkey, 'both' FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'))")
def set_diff(spark, sf_dir):
    of = lambda s: table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("id"))
    return of("F").subtract(of("O")).withColumn("side", F.lit("only_f")).unionByName(of("F").intersect(of("O")).withColumn("side", F.lit("both")))


@plans.add("SELECT p_name, min(p_partkey) AS first_key FROM part GROUP BY p_name")
def distinct_first(spark, sf_dir):
    return J.names_first(table(spark, sf_dir, "part").select("p_name", F.col("p_partkey").alias("first_key")), "p_name", ["first_key"])


@plans.add("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def existence_probe(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey")


#: Where names lead, by priority.
@plans.add("""WITH t AS (SELECT 1 AS prio, p_partkey AS pos, p_name AS title, 'part/' || CAST(p_partkey AS VARCHAR) AS href FROM part UNION ALL SELECT 2, n_nationkey, n_name, 'nation/' || CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT 3, s_suppkey, s_name, 'supplier/' || CAST(s_suppkey AS VARCHAR) FROM supplier),
    f AS (SELECT title, href FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY prio, pos) AS k FROM t) WHERE k = 1), e AS (SELECT n_name AS title FROM nation UNION ALL SELECT DISTINCT p_name FROM part UNION ALL SELECT r_name FROM region) SELECT e.title, f.href FROM e LEFT JOIN f ON e.title = f.title""")
def title_targets(spark, sf_dir):
    one = lambda t, prio, key, name, kind: table(spark, sf_dir, t).select(F.lit(prio).alias("prio"), F.col(key).cast("bigint").alias("pos"), F.col(name).alias("title"), F.concat(F.lit(kind + "/"), F.col(key).cast("string")).alias("href"))
    targets = one("part", 1, "p_partkey", "p_name", "part").unionByName(one("nation", 2, "n_nationkey", "n_name", "nation")).unionByName(one("supplier", 3, "s_suppkey", "s_name", "supplier"))
    entries = table(spark, sf_dir, "nation").select(F.col("n_name").alias("title")).unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("title")).distinct()).unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("title")))
    return entries.join(J.names_first(targets, "title", ["prio", "pos"]).select("title", "href"), "title", "left")
