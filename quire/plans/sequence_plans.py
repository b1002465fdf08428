"""Queries of sequence and geometry operators."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.operators import sequence as Q
from quire.plans.base import Plans, table

plans = Plans()


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ms", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint"))


@plans.add("SELECT user_id, CAST(ts AS DATE)::VARCHAR AS day, string_agg(event_type, ' ' ORDER BY ts, event_id) AS line FROM events GROUP BY ALL")
def baseline_bucket(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("day", F.col("ts").cast("date").cast("string"))
    return e.groupBy("user_id", "day").agg(F.array_join(Q.ordered_list(["ms", "event_id"], "event_type"), " ").alias("line"))


GAPS = "g AS (SELECT *, epoch_ms(ts) - lag(epoch_ms(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events), r AS (SELECT *, sum(CASE WHEN gap > 2400000 OR gap IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM g)"


@plans.add(f"WITH {GAPS} SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM r GROUP BY ALL")
def gap_bands(spark, sf_dir):
    e = Q.gap_islands(events(spark, sf_dir), ["user_id"], ["ms", "event_id"], F.col("ms"), 2_400_000)
    return e.groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@plans.add("""WITH RECURSIVE v AS (SELECT o_custkey AS k, list_sort(list(o_totalprice)) AS xs FROM orders GROUP BY o_custkey), b(k, xs, i, start, n) AS (SELECT k, xs, 1, xs[1], 1 FROM v UNION ALL
    SELECT k, xs, i + 1, CASE WHEN xs[i + 1] - start > 40000 THEN xs[i + 1] ELSE start END, CASE WHEN xs[i + 1] - start > 40000 THEN n + 1 ELSE n END FROM b WHERE i < len(xs)) SELECT k AS o_custkey, CAST(max(n) AS BIGINT) AS bands, max(start) AS last_start FROM b GROUP BY k""")
def anchored_bands(spark, sf_dir):
    v = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_totalprice")).alias("xs"))
    v = v.select("o_custkey", Q.anchored_bands(F.col("xs"), 40000).alias("starts"))
    return v.select("o_custkey", F.size("starts").cast("bigint").alias("bands"), F.element_at("starts", -1).alias("last_start"))


@plans.add("""WITH RECURSIVE v AS (SELECT o_custkey AS k, list_sort(list(o_totalprice)) AS xs FROM orders GROUP BY o_custkey), b(k, xs, i, start, n) AS (SELECT k, xs, 1, xs[1], 0 FROM v UNION ALL
    SELECT k, xs, i + 1, CASE WHEN xs[i + 1] - start > 40000 THEN xs[i + 1] ELSE start END, CASE WHEN xs[i + 1] - start > 40000 THEN n + 1 ELSE n END FROM b WHERE i < len(xs)), s AS (SELECT DISTINCT k, n, start FROM b)
    SELECT o_orderkey, CAST(max(CASE WHEN o_totalprice >= start - 500 THEN n ELSE 0 END) AS INTEGER) AS band FROM orders JOIN s ON k = o_custkey GROUP BY o_orderkey""")
def column_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    v = o.groupBy("o_custkey").agg(Q.anchored_bands(F.array_sort(F.collect_list("o_totalprice")), 40000).alias("starts"))
    return o.join(v, "o_custkey").select("o_orderkey", Q.band_of(F.col("o_totalprice"), F.col("starts"), 500).alias("band"))


@plans.add("""WITH s AS (SELECT o_custkey AS c, epoch_ms(least(o_orderdate, l_shipdate)) // 86400000 AS x0, epoch_ms(greatest(o_orderdate, l_shipdate)) // 86400000 AS x1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
    m AS (SELECT *, max(x1) OVER (PARTITION BY c ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), r AS (SELECT *, sum(CASE WHEN reach IS NULL OR x0 > reach + 7 THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY x0, x1 ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT c AS o_custkey, CAST(run AS BIGINT) AS run, min(x0) AS x0, max(x1) AS x1, count(*) AS n FROM r GROUP BY ALL""")
def interval_merge(spark, sf_dir):
    day = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 86_400_000_000).cast("bigint")
    s = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    s = s.select("o_custkey", day(F.least("o_orderdate", "l_shipdate")).alias("x0"), day(F.greatest("o_orderdate", "l_shipdate")).alias("x1"))
    return Q.merged_intervals(s, ["o_custkey"], "x0", "x1", 7)


@plans.add("""WITH g AS (SELECT user_id, (epoch_ms(ts) - lag(epoch_ms(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 60000.0::DOUBLE AS gap FROM events), k AS (SELECT user_id, list_sort(list(round_even(gap, 1))) AS xs FROM g WHERE gap > 0.5 GROUP BY user_id),
    f AS (SELECT user_id, list_filter(xs, lambda x: x * 2 >= xs[len(xs)]) AS xs FROM k), s AS (SELECT user_id, xs, list_max(list_transform(range(1, len(xs)), lambda i: struct_pack(r := xs[i + 1] / xs[i], o := -i, m := (xs[i + 1] + xs[i]) / 2))) AS best FROM f)
    SELECT u.user_id, round(CASE WHEN xs IS NULL THEN 0 WHEN len(xs) > 1 AND best.r >= 1.15 THEN best.m ELSE xs[1] - 1 END, 4) AS threshold FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN s ON s.user_id = u.user_id""")
def adaptive_threshold(spark, sf_dir):
    e = events(spark, sf_dir)
    e = e.withColumn("gap", (F.col("ms") - F.lag("ms").over(W.partitionBy("user_id").orderBy("ms", "event_id"))) / 60000.0)
    gaps = e.groupBy("user_id").agg(F.collect_list("gap").alias("gaps"))
    return gaps.select("user_id", F.round(Q.split_threshold(F.col("gaps")), 4).alias("threshold"))


@plans.add(r"""WITH l AS (SELECT doc_id AS page, i - 1 AS seq, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
    k AS (SELECT *, CASE WHEN trim(line) = '' THEN 'paragraph' WHEN starts_with(ltrim(line), '•') THEN 'bullet' WHEN regexp_matches(line, '^\s*\d+\s*:') THEN 'step' WHEN contains(line, ' | ') THEN 'paragraph' WHEN regexp_matches(line, '^[^a-z]*$') THEN 'heading' ELSE 'paragraph' END AS kind FROM l),
    o AS (SELECT *, CASE WHEN seq = 0 OR kind IN ('bullet', 'step') OR (kind = 'heading') <> (lag(kind) OVER (PARTITION BY page ORDER BY seq) = 'heading') THEN 1 ELSE 0 END AS opens FROM k), r AS (SELECT *, sum(opens) OVER (PARTITION BY page ORDER BY seq) AS run FROM o)
    SELECT page, CAST(run - 1 AS INTEGER) AS block, arg_min(kind, seq) AS kind, CAST(count(*) AS INTEGER) AS lines, string_agg(line, ' ' ORDER BY seq) AS text FROM r GROUP BY page, run""")
def line_blocks(spark, sf_dir):
    """Documents' lines as pages, folded into blocks; the document is the page."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("seq", "text"))
    kind = B.line_kind(F.col("text"))
    lines = lines.select("page", "seq", F.when(kind == "heading", "section").otherwise("body").alias("role"), "text", F.lit(0).alias("column"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("int").alias("level"), F.lit(10.0).alias("size"), F.lit(0.0).alias("x0"), F.length("text").cast("double").alias("x1"), (F.col("seq") * 12.0).alias("y"), F.lit(False).alias("bold"), F.lit(False).alias("bold_open"))
    return B.page_blocks(lines).select("page", "block", "kind", "lines", "text")


@plans.add(r"""WITH l AS (SELECT doc_id, i AS seq, ls[i] AS line, (i - 1) // 3 AS place FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
    o AS (SELECT *, CASE WHEN seq = 1 OR regexp_matches(rtrim(lag(line) OVER w), '[.:!?”]$') THEN 1 WHEN place <> lag(place) OVER w THEN 0 END AS opens FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
    f AS (SELECT *, last_value(opens IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS o2 FROM o), r AS (SELECT *, sum(o2) OVER (PARTITION BY doc_id ORDER BY seq) AS run FROM f)
    SELECT doc_id, CAST(run AS BIGINT) AS run, string_agg(line, ' ' ORDER BY seq) AS line, count(*) AS n FROM r GROUP BY doc_id, run""")
def paragraph_stitch(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line")).withColumn("place", F.floor(F.col("seq") / 3))
    return B.stitched(lines, ["doc_id"], ["seq"], "line", ["place"])


LEVEL = "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 END"


@plans.add(f"""WITH e AS (SELECT *, {LEVEL} AS lv, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events), w AS (SELECT *, max(CASE WHEN lv = 1 THEN pos END) OVER o AS p1, max(CASE WHEN lv = 2 THEN pos END) OVER o AS p2, max(CASE WHEN lv = 3 THEN pos END) OVER o AS p3 FROM e WINDOW o AS (PARTITION BY user_id ORDER BY pos)),
    l AS (SELECT *, coalesce(p1, 0) AS a, CASE WHEN p2 > coalesce(p1, 0) THEN p2 END AS b, CASE WHEN p3 > greatest(coalesce(p1, 0), coalesce(p2, 0)) THEN p3 END AS c FROM w)
    SELECT l.event_id, concat_ws('/', CAST(x.event_id AS VARCHAR), CAST(y.event_id AS VARCHAR), CAST(z.event_id AS VARCHAR)) AS path FROM l LEFT JOIN e x ON x.user_id = l.user_id AND x.pos = l.a LEFT JOIN e y ON y.user_id = l.user_id AND y.pos = l.b LEFT JOIN e z ON z.user_id = l.user_id AND z.pos = l.c""")
def heading_path(spark, sf_dir):
    level = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "error", 3)
    e = events(spark, sf_dir).withColumn("level", level).withColumn("title", F.col("event_id").cast("string"))
    return Q.heading_path(e, ["user_id"], ["ms", "event_id"], "level", "title", 3).select("event_id", F.array_join("path", "/").alias("path"))


@plans.add("""WITH r AS (SELECT *, greatest(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS u FROM conversations), f AS (SELECT *, u + CASE WHEN first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'user' THEN 0 ELSE 1 END AS run FROM r)
    SELECT conv_id, CAST(run AS BIGINT) AS run, string_agg(role, '>' ORDER BY turn) AS roles, count(*) AS n FROM f GROUP BY conv_id, run""")
def run_absorb(spark, sf_dir):
    c = Q.islands(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user")
    return c.groupBy("conv_id", "run").agg(F.array_join(Q.ordered_list(["turn"], "role"), ">").alias("roles"), F.count("*").alias("n"))


@plans.add(r"""WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS b FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS k FROM s) SELECT p_partkey, CASE WHEN k = 1 THEN b ELSE b || '-' || k END AS id FROM n""")
def occurrence_ids(spark, sf_dir):
    from quire.functions.text import slugify

    return Q.occurrence_ids(table(spark, sf_dir, "part"), slugify(F.col("p_name")), ["p_partkey"]).select("p_partkey", "id")


@plans.add("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS label FROM events")
def fill_forward(spark, sf_dir):
    return Q.fill_forward(events(spark, sf_dir), ["user_id"], ["ms", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "label").select("event_id", "label")


@plans.add("""WITH r AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS section FROM events) SELECT user_id, CAST(section AS BIGINT) AS section, count(*) AS n, round(sum(value), 4) AS total FROM r WHERE event_type = 'purchase' AND section > 0 GROUP BY ALL""")
def section_slices(spark, sf_dir):
    e = events(spark, sf_dir)
    section = F.sum(F.when(F.col("event_type") == "signup", 1).otherwise(0)).over(W.partitionBy("user_id").orderBy("ms", "event_id").rowsBetween(W.unboundedPreceding, 0))
    return e.withColumn("section", section.cast("bigint")).filter("event_type = 'purchase' AND section > 0").groupBy("user_id", "section").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@plans.add("""WITH r AS (SELECT *, 1 + coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM events)
    SELECT user_id, CAST(run AS BIGINT) AS run, string_agg(event_type, ' ' ORDER BY ts, event_id) AS title, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS page FROM r GROUP BY user_id, run""")
def carry_over(spark, sf_dir):
    e = Q.carried(events(spark, sf_dir), ["user_id"], ["ms", "event_id"], F.col("event_type") == "purchase")
    return e.groupBy("user_id", "run").agg(F.array_join(Q.ordered_list(["ms", "event_id"], "event_type"), " ").alias("title"), F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("page"))


@plans.add(r"""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?]+)', 1) AS host, regexp_extract(url, '://[^/?]+(/[^?]*)', 1) AS path, regexp_extract(url, '\?(.*)$', 1) AS query FROM pages""")
def label_slices(spark, sf_dir):
    from quire.operators.sequence import labelled_slices

    m = labelled_slices(F.concat(F.lit("scheme:"), F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "://", " host:"), r"(host:[^/?]+)(/[^?]*)?", "$1 path:$2"), r"\?", " query:")), ["scheme:", "host:", "path:", "query:"])
    return table(spark, sf_dir, "pages").select("page_id", *[F.coalesce(F.try_element_at(m, F.lit(k + ":")), F.lit("")).alias(k) for k in ("scheme", "host", "path", "query")])


@plans.add("""WITH r AS (SELECT *, sum(CASE WHEN event_type IN ('view', 'click', 'signup') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS bad FROM events) SELECT event_id FROM r WHERE bad = 0""")
def leading_run(spark, sf_dir):
    return Q.leading_run(events(spark, sf_dir), ["user_id"], ["ms", "event_id"], F.col("event_type").isin("view", "click", "signup")).select("event_id")


@plans.add("""WITH f AS (SELECT n_regionkey AS r, CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE NULL END AS sub, n_name, n_nationkey AS k FROM nation) SELECT r AS region, sub, string_agg(n_name, '|' ORDER BY k) AS features, row_number() OVER (PARTITION BY r ORDER BY sub IS NOT NULL, sub) AS place FROM f GROUP BY r, sub""")
def nested_group(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.when(F.col("n_nationkey") % 2 == 0, "even").alias("sub"), "n_name", "n_nationkey")
    g = n.groupBy("region", "sub").agg(F.array_join(Q.ordered_list(["n_nationkey"], "n_name"), "|").alias("features"))
    return g.select("*", F.row_number().over(W.partitionBy("region").orderBy(F.col("sub").isNotNull(), "sub")).cast("bigint").alias("place"))
