"""Queries of aggregation, trees, search, profiles and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import profile as R
from quire.operators import search as S
from quire.operators import sequence as Q
from quire.operators import tree as T
from quire.operators import validate as V
from quire.plans.base import Plans, table

plans = Plans()


@plans.add("""SELECT o_custkey, arg_min(p, struct_pack(w := -w, f := f)) AS mode, CAST(max(w) AS BIGINT) AS weight FROM (SELECT o_custkey, o_orderpriority AS p, sum(length(o_orderpriority)) AS w, min(o_orderkey) AS f FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def weighted_mode(spark, sf_dir):
    return Q.weighted_mode(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", F.length("o_orderpriority"), "o_orderkey")


@plans.add("""SELECT l_suppkey, arg_min(q, struct_pack(n := -n, q := q)) AS mode, max(n) AS n FROM (SELECT l_suppkey, l_quantity AS q, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""")
def mode_leftmost(spark, sf_dir):
    return Q.leftmost_mode(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity")


@plans.add(r"""SELECT conv_id, string_agg(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ' ORDER BY turn, role) FILTER (trim(regexp_replace(text, '\s+', ' ', 'g')) <> '') AS joined FROM conversations GROUP BY conv_id""")
def ordered_concat(spark, sf_dir):
    got = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(Q.ordered_list(["turn", "role"], "text").alias("lines"))
    return got.select("conv_id", X.joined_lines(F.col("lines")).alias("joined"))


@plans.add("""SELECT l_orderkey, min(l_quantity) AS x0, max(l_quantity) AS x1, round_even(min(l_discount) - max(l_tax), 1) + 0.0 AS y0, round_even(max(l_discount) + 0.3 * max(l_tax), 1) AS y1, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS pages FROM lineitem GROUP BY l_orderkey""")
def bbox(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_quantity").alias("x0"),
        F.max("l_quantity").alias("x1"),
        F.bround(F.min("l_discount") - F.max("l_tax"), 1).alias("y0"),
        F.bround(F.max("l_discount") + 0.3 * F.max("l_tax"), 1).alias("y1"),
        F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("pages"),
    )


NATION = ["n_nationkey", "n_name", "n_regionkey"]


@plans.add("""SELECT 'n_nationkey' AS path, 'integer' AS types, false AS nullable, count(*) AS present, CAST(0 AS BIGINT) AS strings FROM nation UNION ALL SELECT 'n_name', 'string', false, count(*), count(DISTINCT n_name) FROM nation UNION ALL SELECT 'n_regionkey', 'integer', false, count(*), 0 FROM nation
    UNION ALL SELECT 'props.k', 'integer', false, count(*), 0 FROM events""")
def schema_profile(spark, sf_dir):
    a = R.profile(R.leaves(table(spark, sf_dir, "nation"), NATION))
    b = R.profile(R.json_leaves(table(spark, sf_dir, "events"), "props").withColumn("path", F.concat(F.lit("props."), "path")))
    return a.unionByName(b).select("path", F.array_join("types", "|").alias("types"), "nullable", "present", "strings")


@plans.add("""WITH c AS (SELECT conv_id, turn, role, text FROM conversations), n AS (SELECT count(DISTINCT conv_id) AS n FROM c) SELECT 'conv_id' AS path, 'integer' AS types, false AS nullable, n AS present, 0 AS strings FROM n UNION ALL SELECT 'turns', 'array', false, n, 0 FROM n UNION ALL SELECT 'turns[]', 'object', false, count(*), 0 FROM c UNION ALL SELECT 'turns[].role', 'string', count(role) < count(*), count(*), count(DISTINCT role) FROM c UNION ALL SELECT 'turns[].turn', 'integer', count(turn) < count(*), count(*), 0 FROM c UNION ALL SELECT 'turns[].sizes', 'object', false, count(*), 0 FROM c UNION ALL SELECT 'turns[].sizes.' || role, 'integer', count(text) < count(*), count(*), 0 FROM c GROUP BY role""")
def schema_nested(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("sizes", F.create_map("role", F.length("text")))
    rows = turns.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "sizes")).alias("turns"))
    return R.profile(R.nested_leaves(rows, ["conv_id", "turns"])).select("path", F.array_join("types", "|").alias("types"), "nullable", "present", "strings")


@plans.add("""SELECT 'o_orderstatus' AS path, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS "values" FROM orders UNION ALL SELECT 'o_orderpriority', string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) FROM orders""")
def enum_extract(spark, sf_dir):
    return R.enumerations(R.leaves(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])).select("path", F.array_join("values", "|").alias("values"))


@plans.add("""SELECT 'quality' AS path, count(quality) = count(*) AS required FROM labels UNION ALL SELECT 'toxic', count(toxic) = count(*) FROM labels UNION ALL SELECT 'low', count(CASE WHEN quality = 0 THEN 1 END) = count(*) FROM labels""")
def required_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("low", F.when(F.col("quality") == 0, 1))
    leaf = R.leaves(rows, ["quality", "toxic", "low"])
    return leaf.groupBy("path").agg((F.count_if(F.col("type") != "null") == F.count("*")).alias("required"))


@plans.add(r"""WITH i AS (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS id FROM part UNION ALL SELECT trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') FROM supplier UNION ALL SELECT trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') FROM customer) SELECT id, count(*) AS n FROM i GROUP BY id HAVING count(*) > 1""")
def duplicate_ids(spark, sf_dir):
    of = lambda t, c: table(spark, sf_dir, t).select(X.slugify(F.col(c)).alias("id"))
    return V.duplicate_ids(of("part", "p_name").unionByName(of("supplier", "s_name")).unionByName(of("customer", "c_name")))


EXPECTED = [("regions", 5), ("nations", 25), ("bare_nations", 0), ("parts_without_brand", 0), ("unknown", 1)]


@plans.add("""WITH e(name, expected) AS (VALUES ('regions', 5), ('nations', 25), ('bare_nations', 0), ('parts_without_brand', 0), ('unknown', 1)), a AS (SELECT 'regions' AS name, count(*) AS actual FROM region UNION ALL SELECT 'nations', count(*) FROM nation UNION ALL SELECT 'bare_nations', count_if(trim(n_name) = '') FROM nation UNION ALL SELECT 'parts_without_brand', count_if(p_brand IS NULL) FROM part)
    SELECT e.name, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, expected IS NOT DISTINCT FROM actual AS passed FROM e LEFT JOIN a ON e.name = a.name""")
def conformance(spark, sf_dir):
    count = lambda name, t, cond=None: table(spark, sf_dir, t).agg((F.count("*") if cond is None else F.count_if(cond)).alias("actual")).select(F.lit(name).alias("name"), "actual")
    actual = count("regions", "region").unionByName(count("nations", "nation")).unionByName(count("bare_nations", "nation", F.trim("n_name") == "")).unionByName(count("parts_without_brand", "part", F.col("p_brand").isNull()))
    return V.compare(spark.createDataFrame(EXPECTED, "name string, expected bigint"), actual)


@plans.add("""WITH v AS (SELECT DISTINCT c_mktsegment AS value FROM customer) SELECT value, row_number() OVER (ORDER BY value COLLATE es) AS place FROM v""")
def facets(spark, sf_dir):
    from pyspark.sql import Window as W

    return S.facet_values(table(spark, sf_dir, "customer"), "c_mktsegment").select("value", F.row_number().over(W.orderBy(F.collate("value", "es"))).cast("bigint").alias("place"))


@plans.add("""SELECT c_custkey, count(o_orderkey) AS n, count(o_orderkey) > 40 AS split FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def split_sections(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    got = table(spark, sf_dir, "customer").join(counts, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))
    return got.withColumn("split", F.col("n") > 40)


@plans.add("""SELECT event_type, count(*) AS baselines FROM (SELECT DISTINCT event_type, user_id, date_trunc('minute', ts) FROM events) GROUP BY event_type""")
def distinct_baselines(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "user_id", F.date_trunc("minute", "ts").alias("m")).distinct().groupBy("event_type").agg(F.count("*").alias("baselines"))


def places(spark, sf_dir):
    """Regions, nations and customers as one tree under a root."""
    node = lambda df, i, p, kind, title, pos: df.select(i.alias("node_id"), p.alias("parent_id"), pos.cast("bigint").alias("pos"), F.lit(kind).alias("type"), title.alias("title"))
    key = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    root = spark.createDataFrame([("w", None, 0, "root", "world")], "node_id string, parent_id string, pos bigint, type string, title string")
    r = node(table(spark, sf_dir, "region"), key("r", "r_regionkey"), F.lit("w"), "region", F.col("r_name"), F.col("r_regionkey"))
    n = node(table(spark, sf_dir, "nation"), key("n", "n_nationkey"), key("r", "n_regionkey"), "nation", F.col("n_name"), F.col("n_nationkey"))
    c = node(table(spark, sf_dir, "customer"), key("c", "c_custkey"), key("n", "c_nationkey"), "customer", F.col("c_name"), F.col("c_custkey"))
    return root.unionByName(r).unionByName(n).unionByName(c)


WALK = """SELECT 'c' || c_custkey AS node_id, 3 AS depth, 'world/' || r_name || '/' || n_name AS path FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'n' || n_nationkey, 2, 'world/' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'r' || r_regionkey, 1, 'world' FROM region UNION ALL SELECT 'w', 0, ''"""


@plans.add(WALK)
def tree_walk_recursive(spark, sf_dir):
    return T.walk(spark, places(spark, sf_dir)).select("node_id", "depth", F.array_join("path", "/").alias("path"))


@plans.add("""SELECT 'c' || c_custkey AS node_id, r_name || '/' || n_name AS context, n_name AS parent FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""")
def ancestor_filter(spark, sf_dir):
    got = T.entries_under(T.walk(spark, places(spark, sf_dir)), "customer", "EUROPE")
    return got.select("node_id", F.array_join(T.context(F.col("path")), "/").alias("context"), T.parent_title(F.col("path")).alias("parent"))


@plans.add("""SELECT r_name AS title, string_agg(n_name, '|' ORDER BY n_nationkey) AS children FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def outline(spark, sf_dir):
    nodes = places(spark, sf_dir)
    return T.outline(nodes.filter("type = 'nation'"), nodes.filter("type = 'region'")).select("title", F.array_join("children", "|").alias("children"))


@plans.add("""SELECT n_regionkey AS region, '| key | name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY n_regionkey""")
def render_markdown(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.array(x["n_nationkey"].cast("string"), x["n_name"])).alias("rows"))
    return rows.select("region", T.markdown_table(["key", "name"], F.col("rows")).alias("text"))


@plans.add("""SELECT r_name AS chapter, '# ' || r_name || string_agg(chr(10) || chr(10) || '## ' || n_name || chr(10) || chr(10) || 'nation ' || n_nationkey, '' ORDER BY n_nationkey) || chr(10) AS text FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def chapter_markdown(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    head = table(spark, sf_dir, "region").select(F.col("r_name").alias("chapter"), F.lit(-1).cast("bigint").alias("pos"), F.lit("chapter").alias("type"), F.col("r_name").alias("title"), F.lit(None).cast("string").alias("md"))
    section = n.select(F.col("r_name").alias("chapter"), (F.col("n_nationkey") * 2).cast("bigint").alias("pos"), F.lit("section").alias("type"), F.col("n_name").alias("title"), F.lit(None).cast("string").alias("md"))
    body = n.select(F.col("r_name").alias("chapter"), (F.col("n_nationkey") * 2 + 1).cast("bigint").alias("pos"), F.lit("paragraph").alias("type"), F.lit(None).cast("string").alias("title"), F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("md"))
    return T.markdown(head.unionByName(section).unionByName(body), "chapter")


TOKENS = r"t AS (SELECT {id} AS id, unnest(list_filter(regexp_split_to_array(lower(strip_accents({text})), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS token FROM {table})"


@plans.add("WITH " + TOKENS.format(id="doc_id", text="text", table="documents") + " SELECT id FROM t WHERE token IN ('the', 'of') GROUP BY id HAVING count(DISTINCT token) = 2")
def fts_match(spark, sf_dir):
    return S.match_all(S.postings(table(spark, sf_dir, "documents"), "doc_id", ["text"]), ["the", "of"])


@plans.add("WITH " + TOKENS.format(id="item_id", text="text", table="benchmark") + """, l AS (SELECT id, count(*) AS n FROM t GROUP BY id), w AS (SELECT count(*) AS docs, avg(n) AS mean FROM l), h AS (SELECT token, id, count(*) AS tf FROM t WHERE token IN ('the', 'der', 'que') GROUP BY ALL), d AS (SELECT token, count(*) AS df FROM h GROUP BY token)
    SELECT h.id, round(sum(ln((docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score FROM h JOIN d USING (token) JOIN l USING (id) CROSS JOIN w GROUP BY h.id""")
def fts_rank(spark, sf_dir):
    return S.ranked(S.postings(table(spark, sf_dir, "benchmark"), "item_id", ["text"]), ["the", "der", "que"])


@plans.add(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT CASE WHEN trim(line) = '' THEN 'blank' WHEN starts_with(ltrim(line), '•') THEN 'bullet' WHEN regexp_matches(line, '^\s*\d+\s*:') THEN 'step' WHEN contains(line, ' | ') THEN 'row' WHEN regexp_matches(line, '^[^a-z]*$') THEN 'heading' WHEN regexp_matches(line, ':\s*$') THEN 'label' ELSE 'paragraph' END AS kind, count(*) AS n FROM l GROUP BY ALL""")
def block_classify(spark, sf_dir):
    from quire.operators.blocks import line_kind

    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(line_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"))


@plans.add("""WITH n AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT n_nationkey, coalesce(n, 0) > 40 AS split FROM nation LEFT JOIN n ON c_nationkey = n_nationkey)
    SELECT CASE WHEN split THEN 'index' ELSE 'section' END AS kind, 'n' || n_nationkey AS node_id FROM s UNION ALL SELECT 'entry', 'c' || c_custkey FROM customer JOIN s ON c_nationkey = n_nationkey WHERE split
    UNION ALL SELECT 'chapter', 'r' || r_regionkey FROM region WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey)""")
def site_pages(spark, sf_dir):
    kinds = F.create_map(*[F.lit(x) for x in ("region", "chapter", "nation", "section", "customer", "entry")])
    return T.site_pages(places(spark, sf_dir).withColumn("type", F.try_element_at(kinds, F.col("type"))))


@plans.add("""SELECT n_name AS ancestor, min(c_custkey) AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 UNION ALL SELECT r_name, min(c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
    UNION ALL SELECT 'world', min(c_custkey) FROM customer""")
def first_descendant(spark, sf_dir):
    walked = T.walk(spark, places(spark, sf_dir)).withColumn("place", F.col("pos"))
    return T.first_below(walked, F.col("type") == "customer", ["place"]).withColumnRenamed("place", "pos")


@plans.add("""SELECT conv_id, part, no, md FROM (SELECT conv_id, 'asked' AS part, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS no, text AS md FROM conversations WHERE role = 'user'
    UNION ALL SELECT conv_id, 'told', row_number() OVER (PARTITION BY conv_id ORDER BY turn, role), text FROM conversations WHERE role <> 'user')""")
def block_enumeration(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    part = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("turn", "role", "text")))), lambda x: F.struct(x["text"].alias("md")))
    got = c.groupBy("conv_id").agg(part(F.col("role") == "user").alias("a"), part(F.col("role") != "user").alias("b"))
    each = F.explode(T.enumerated([("asked", F.col("a")), ("told", F.col("b"))])).alias("x")
    return got.select("conv_id", each).select("conv_id", "x.part", F.col("x.no").cast("bigint").alias("no"), "x.md")
