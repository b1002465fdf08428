"""Queries of the scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import parse as P
from quire.functions import text as X
from quire.plans.base import Plans, table

plans = Plans()


@plans.add(r"""SELECT page_id, translate(url || chr(173) || chr(160) || 'a' || chr(8209) || chr(8203) || 'b', chr(160) || chr(8209) || chr(173) || chr(8203), ' -') AS cleaned,
    translate(url || chr(8722) || chr(8211), chr(8722) || chr(8211), '--') AS numeric_text, true AS hyphenated FROM pages""")
def clean_text(spark, sf_dir):
    s = F.concat("url", F.lit("­ a‑​b"))
    return table(spark, sf_dir, "pages").select("page_id", X.clean(s).alias("cleaned"), X.minus(F.concat("url", F.lit("−–"))).alias("numeric_text"), X.ends_hyphenated(F.concat("url", F.lit("­ "))).alias("hyphenated"))


@plans.add(r"""SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents""")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.slugify(F.col("text")).alias("slug"))


@plans.add(r"""SELECT doc_id, lower(strip_accents(text)) AS folded FROM documents""")
def accent_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.sort_key(F.col("text")).alias("folded"))


@plans.add(r"""SELECT p_partkey, p_name AS runin, p_type || ' text' AS rest FROM part""")
def split_runin(spark, sf_dir):
    s = F.concat(F.lit("**"), "p_name", F.lit(".** "), "p_type", F.lit(" text"))
    name, rest = X.split_runin(s)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("runin"), rest.alias("rest"))


@plans.add(r"""SELECT p_partkey, array_to_string(regexp_extract_all(regexp_replace('see *' || p_name || '* and **' || p_type || '** or *' || p_brand || '*', '\*{2,}', '', 'g'), '\*([^*]+)\*', 1), '|') AS marked FROM part""")
def emphasis_extract(spark, sf_dir):
    s = F.concat(F.lit("see *"), "p_name", F.lit("* and **"), "p_type", F.lit("** or *"), "p_brand", F.lit("*"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.emphasised(s), "|").alias("marked"))


@plans.add(r"""WITH s AS (SELECT doc_id, array_to_string(list_slice(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), 1, 8), ' ') AS f FROM documents)
    SELECT doc_id, CASE WHEN length(f) >= 20 THEN f END AS fragment FROM s""")
def fragment8(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.fragment(F.col("text")).alias("fragment"))


@plans.add(r"""SELECT page_id, upper(substr(url, 1, 1)) || lower(substr(url, 2)) AS capital FROM pages""")
def capitalise(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.capitalise(F.col("url")).alias("capital"))


@plans.add(r"""SELECT p_partkey, array_to_string(list_filter(list_transform(regexp_split_to_array(p_name || ' ; ,' || p_type || ', ' || p_brand, '[;,]'), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM part""")
def list_split(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.list_split(F.concat("p_name", F.lit(" ; ,"), "p_type", F.lit(", "), "p_brand")), "|").alias("parts"))


@plans.add(r"""SELECT c_custkey, c_name AS label, c_mktsegment || ':' || CAST(c_nationkey AS VARCHAR) AS value FROM customer""")
def label_value(spark, sf_dir):
    a, b = X.label_value(F.concat("c_name", F.lit(" : "), "c_mktsegment", F.lit(":"), F.col("c_nationkey").cast("string")))
    return table(spark, sf_dir, "customer").select("c_custkey", a.alias("label"), b.alias("value"))


@plans.add(r"""SELECT p_partkey, p_name AS bare, CAST(p_size AS VARCHAR) AS inside, true AS is_label FROM part""")
def paren_parts(spark, sf_dir):
    s = F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", X.without_parens(s).alias("bare"), X.in_parens(s).alias("inside"), X.is_label(F.concat("p_name", F.lit(": ")), ["nota"]).alias("is_label"))


@plans.add(r"""SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, CAST(len(list_filter(string_split(text, chr(10)), lambda x: starts_with(ltrim(x), '•'))) AS BIGINT) AS bullets,
    CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*\d+\s*:'))) AS BIGINT) AS steps FROM documents""")
def list_markers(spark, sf_dir):
    lines = F.split("text", "\n")
    count = lambda k: F.size(F.filter(F.transform(lines, X.list_kind), lambda x: x == k)).cast("bigint")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(lines).cast("bigint").alias("n_lines"), count("bullet").alias("bullets"), count("step").alias("steps"))


@plans.add(r"""SELECT p_partkey, replace(replace(p_name || '|' || p_type || chr(10) || p_brand, '|', '\|'), chr(10), ' ') AS cell, p_name || ',,' AS padded FROM part""")
def cell_escape(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.cell(F.concat("p_name", F.lit("|"), "p_type", F.lit("\n"), "p_brand")).alias("cell"), F.array_join(X.padded(F.array("p_name"), F.lit(3)), ",").alias("padded"))


@plans.add(r"""SELECT p_partkey, '<strong><em>' || p_name || '</em></strong> <strong>a&amp;b</strong> <em>' || p_type || '</em> &lt;i&gt;' AS html FROM part""")
def markdown_html(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.html_of(F.concat(F.lit("***"), "p_name", F.lit("*** **a&b** *"), "p_type", F.lit("* <i>"))).alias("html"))


@plans.add(r"""SELECT p_partkey, '#' || printf('%06X', CAST(p_partkey * 977 % 16777216 AS BIGINT)) AS colour FROM part""")
def colour_hex(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.colour(F.col("p_partkey") * 977 % 16777216).alias("colour"))


@plans.add(r"""SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) / 4 WHEN p_partkey % 3 = 1 THEN -(p_size + 0.5) ELSE p_size END AS DOUBLE) AS number,
    CASE WHEN p_partkey % 3 = 2 THEN p_size * 1000.0::DOUBLE END AS grouped FROM part""")
def number_parse(spark, sf_dir):
    size = F.col("p_size").cast("string")
    s = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("CR "), size, F.lit("/4"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("−"), size, F.lit(",5 m"))).otherwise(size)
    g = F.when(F.col("p_partkey") % 3 == 2, F.concat(size, F.lit(".000")))
    return table(spark, sf_dir, "part").select("p_partkey", P.number(s).alias("number"), P.grouped_number(g).alias("grouped"))


@plans.add(r"""SELECT p_partkey, CAST(p_size AS DOUBLE) AS amount, c AS coin, round_even(p_size * CAST(CASE c WHEN 'pc' THEN 0.01 WHEN 'pp' THEN 0.1 WHEN 'pe' THEN 0.5 WHEN 'po' THEN 1 ELSE 10 END AS DOUBLE), 4) AS gp
    FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN 'pc' WHEN 1 THEN 'pp' WHEN 2 THEN 'pe' WHEN 3 THEN 'po' ELSE 'ppt' END AS c FROM part)""")
def price_parse(spark, sf_dir):
    coin = F.element_at(F.array(*map(F.lit, ("pc", "pp", "pe", "po", "ppt"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    a, c, g = P.price(F.concat(F.col("p_size").cast("string"), F.lit(" "), coin))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("amount"), c.alias("coin"), g.alias("gp"))


@plans.add(r"""SELECT p_partkey, p_size + 0.5::DOUBLE AS kg FROM part""")
def weight_parse(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", P.weight(F.concat(F.lit("peso "), F.col("p_size").cast("string"), F.lit(",5 kg"))).alias("kg"))


@plans.add(r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '—' WHEN 1 THEN '1/' || CAST(p_size + 1 AS VARCHAR) WHEN 2 THEN CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) || '.5' END AS shown FROM part""")
def fraction_display(spark, sf_dir):
    k = F.col("p_partkey") % 4
    x = F.when(k == 1, 1 / (F.col("p_size") + 1)).when(k == 2, F.col("p_size").cast("double")).when(k == 3, F.col("p_size") + F.lit(0.5))
    return table(spark, sf_dir, "part").select("p_partkey", P.fraction_display(x).alias("shown"))


@plans.add(r"""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'self' WHEN 1 THEN 'touch' WHEN 2 THEN 'ranged' WHEN 3 THEN 'ranged' WHEN 4 THEN 'sight' ELSE 'special' END AS kind,
    CAST(CASE p_partkey % 6 WHEN 2 THEN p_size + 0.5 WHEN 3 THEN p_size * 1000 END AS DOUBLE) AS meters, CASE WHEN p_partkey % 6 = 0 THEN 'cono de ' || CAST(p_size AS VARCHAR) || ' m' END AS shape FROM part""")
def range_kind(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    s = F.when(k == 0, F.concat(F.lit("Lanzador (cono de "), n, F.lit(" m)"))).when(k == 1, "Toque").when(k == 2, F.concat(n, F.lit(",5 m"))).when(k == 3, F.concat(n, F.lit(" km"))).when(k == 4, "A la vista").otherwise("Especial")
    a, b, c = P.reach(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("kind"), b.alias("meters"), c.alias("shape"))


@plans.add(r"""SELECT p_partkey, p_partkey % 2 = 0 AS concentration, CASE WHEN p_partkey % 5 = 1 AND p_partkey % 2 = 1 THEN 'instantaneous' WHEN p_partkey % 5 = 2 THEN 'until-dispelled' WHEN p_partkey % 5 = 3 THEN 'special' ELSE 'timed' END AS kind,
    CAST(CASE WHEN p_partkey % 5 IN (0, 4) OR p_partkey % 10 = 6 THEN p_size END AS DOUBLE) AS value, CASE WHEN p_partkey % 5 = 0 THEN 'minuto' WHEN p_partkey % 5 = 4 THEN 'año' WHEN p_partkey % 10 = 6 THEN 'día' END AS unit FROM part""")
def duration_parse(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    once = F.when(F.col("p_partkey") % 2 == 1, "Instantáneo").otherwise(F.concat(n, F.lit(" días")))
    s = F.when(k == 0, F.concat(n, F.lit(" minutos"))).when(k == 1, once).when(k == 2, "hasta que se disipe").when(k == 3, "especial").otherwise(F.concat(n, F.lit(" años")))
    a, b, c, d = P.duration(F.concat(F.when(F.col("p_partkey") % 2 == 0, "Concentración, hasta ").otherwise(""), s))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("concentration"), b.alias("kind"), c.alias("value"), d.alias("unit"))


@plans.add(r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'action' WHEN 1 THEN 'bonus-action' WHEN 2 THEN 'reaction' ELSE 'time' END AS kind, p_partkey % 4 = 0 AS ritual,
    CAST(CASE WHEN p_partkey % 4 = 3 THEN p_size END AS DOUBLE) AS value, CASE WHEN p_partkey % 4 = 3 THEN 'hora' END AS unit, CASE WHEN p_partkey % 4 = 2 THEN 'realizas cuando cae, o no, ' || p_name END AS trigger FROM part""")
def casting_time(spark, sf_dir):
    k = F.col("p_partkey") % 4
    s = F.when(k == 0, "Acción o ritual").when(k == 1, "Acción adicional").when(k == 2, F.concat(F.lit("Reacción, que realizas cuando cae, o no, "), "p_name")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" horas")))
    a, b, c, d, e = P.casting_time(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("kind"), b.alias("ritual"), c.alias("value"), d.alias("unit"), e.alias("trigger"))


@plans.add(r"""SELECT p_partkey, true AS v, p_partkey % 2 = 0 AS s, true AS m, p_name || ' (' || p_type || '), que se consume' AS material, true AS consumed FROM part""")
def components_parse(spark, sf_dir):
    s = F.concat(F.when(F.col("p_partkey") % 2 == 0, "V, S, M (").otherwise("V, M ("), "p_name", F.lit(" ("), "p_type", F.lit("), que se consume)"))
    a, b, c, d, e = P.components(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("v"), b.alias("s"), c.alias("m"), d.alias("material"), e.alias("consumed"))


@plans.add(r"""SELECT p_partkey, 'Bestia' AS type, CASE WHEN p_partkey % 2 = 0 THEN 'Mediano' ELSE 'Enorme' END AS size, 'legal ' || lower(p_brand) AS alignment, p_name || '|' || p_type AS tags FROM part""")
def meta_last_comma(spark, sf_dir):
    s = F.concat(F.lit("Bestia "), F.when(F.col("p_partkey") % 2 == 0, "Mediana").otherwise("Enorme"), F.lit(" ("), "p_name", F.lit(", "), "p_type", F.lit("), legal "), F.lower("p_brand"))
    a, b, c, d = P.meta_line(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("type"), b.alias("size"), c.alias("alignment"), F.array_join(d, "|").alias("tags"))


@plans.add(r"""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'edificio' WHEN 'MACHINERY' THEN 'maquinaria' END AS canonical FROM customer""")
def canonical_map(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", P.lookup(F.col("c_mktsegment"), {"BUILDING": "edificio", "MACHINERY": "maquinaria"}).alias("canonical"))


@plans.add(r"""SELECT p_partkey, p_name AS name, p_type AS kind FROM part""")
def kind_bracket(spark, sf_dir):
    a, b = P.bracket_kind(F.concat("p_name", F.lit(" ["), "p_type", F.lit("]")))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("name"), b.alias("kind"))


@plans.add(r"""SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) || ' po' AS price FROM part""")
def title_price(spark, sf_dir):
    a, b = P.title_price(F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(" po)")))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("name"), b.alias("price"))


@plans.add(r"""SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS page FROM part""")
def toc_entry(spark, sf_dir):
    s = F.concat("p_name", F.lit(" ....… "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(""))
    a, b = P.contents_entry(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("title"), b.alias("page"))


@plans.add(r"""SELECT p_partkey, CAST(p_size % 21 AS INTEGER) AS level, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size % 10 END AS list_level FROM part""")
def level_titles(spark, sf_dir):
    a, b = P.level_title(F.concat(F.lit("Nivel "), (F.col("p_size") % 21).cast("string"), F.lit(": "), "p_name"))
    c = P.spell_list_level(F.when(F.col("p_partkey") % 2 == 0, "Trucos (conjuros de nivel 0)").otherwise(F.concat(F.lit("Conjuros de nivel "), (F.col("p_size") % 10).cast("string"))))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("level"), b.alias("name"), c.alias("list_level"))


@plans.add(r"""SELECT p_partkey, 'caminando=' || CAST(CAST(p_size + 0.5 AS DOUBLE) AS VARCHAR) || '|volando=' || CAST(CAST(p_size * 2 AS DOUBLE) AS VARCHAR) AS speeds FROM part""")
def speeds_parse(spark, sf_dir):
    m = P.speeds(F.concat(F.col("p_size").cast("string"), F.lit(",5 m, volando "), (F.col("p_size") * 2).cast("string"), F.lit(" m")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), "|").alias("speeds"))


@plans.add(r"""SELECT p_partkey, p_size AS str_score, CAST(-(p_size % 5) AS INTEGER) AS str_mod, 3 AS dex_save, 2 AS n, CAST(p_size % 7 AS INTEGER) AS stealth FROM part""")
def abilities_parse(spark, sf_dir):
    n = F.col("p_size")
    m = P.abilities(F.concat(F.lit("Mod. Salv. Fue "), n.cast("string"), F.lit(" "), F.when(n % 5 == 0, "+").otherwise("−"), (n % 5).cast("string"), F.lit(" +1 Des 12 +1 +3")))
    k = P.signed_map(F.concat(F.lit("Sigilo +"), (n % 7).cast("string"), F.lit(", Percepción −1")))
    return table(spark, sf_dir, "part").select("p_partkey", m["fue"]["score"].alias("str_score"), m["fue"]["mod"].alias("str_mod"), m["des"]["save"].alias("dex_save"), F.size(m).alias("n"), k["Sigilo"].alias("stealth"))


@plans.add(r"""SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN 0.25 WHEN 3 THEN NULL ELSE p_size END AS DOUBLE) AS cr, CASE WHEN p_partkey % 4 < 3 THEN CAST(p_size * 1000 AS BIGINT) END AS xp,
    CASE WHEN p_partkey % 4 < 2 THEN CAST(p_size % 9 + 1 AS INTEGER) END AS bonus, CASE WHEN p_partkey % 4 = 1 THEN CAST(p_size * 1000 + 500 AS BIGINT) END AS lair FROM part""")
def challenge_parse(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    bonus = F.concat(F.lit("; BC +"), (F.col("p_size") % 9 + 1).cast("string"), F.lit(")"))
    first = F.concat(F.lit("1/4 ("), n, F.lit("000 PX"), bonus)
    lair = F.concat(n, F.lit(" ("), n, F.lit(" 000 PX, o "), n, F.lit(" 500 en la guarida"), bonus)
    s = F.when(k == 0, first).when(k == 1, lair).when(k == 2, F.concat(n, F.lit(" ("), n, F.lit(" 000 PX)"))).otherwise("ninguno")
    a, b, c, d = P.challenge(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("cr"), b.alias("xp"), c.alias("bonus"), d.alias("lair"))


@plans.add(r"""SELECT p_partkey, p_name AS name, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) || '/día' WHEN 1 THEN 'recarga 5-6' END AS uses, CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE CAST(p_size AS INTEGER) END AS legendary,
    CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size + 1 AS INTEGER) END AS in_lair FROM part""")
def entry_uses(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    name, used = P.uses(F.when(k == 0, F.concat("p_name", F.lit(" ("), n, F.lit("/día)"))).when(k == 1, F.concat("p_name", F.lit(" (recarga 5-6)"))).otherwise(F.col("p_name")))
    intro = F.when(k == 0, F.concat(F.lit("Usos de acción legendaria: "), n, F.lit(" ("), (F.col("p_size") + 1).cast("string"), F.lit(" en la guarida)."))).when(k == 1, F.concat(F.lit("Puede usarlas así: "), n, F.lit("."))).otherwise("Sin usos")
    all_, lair = P.legendary_uses(intro)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), used.alias("uses"), all_.alias("legendary"), lair.alias("in_lair"))


@plans.add(r"""SELECT p_partkey, p_size AS average, CASE WHEN p_partkey % 3 < 2 THEN CAST(p_size AS VARCHAR) || 'd8' || CASE WHEN p_partkey % 3 = 0 THEN ' - ' || CAST(p_size % 4 AS VARCHAR) ELSE '' END END AS formula, CAST(p_size % 10 AS INTEGER) AS initiative, CAST(p_size AS INTEGER) AS initiative_score FROM part""")
def hit_points(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    dice = F.when(k == 0, F.concat(F.lit(" ("), n, F.lit("d8 −  "), (F.col("p_size") % 4).cast("string"), F.lit(")"))).when(k == 1, F.concat(F.lit(" ("), n, F.lit("d8)"))).otherwise("")
    a, b = P.hit_points(F.concat(n, dice))
    c, d = P.initiative(F.concat(F.lit("+"), (F.col("p_size") % 10).cast("string"), F.lit(" ("), n, F.lit(")")))
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("average"), b.alias("formula"), c.alias("initiative"), d.alias("initiative_score"))


@plans.add(r"""SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size % 9 + 1 END AS INTEGER) AS level, p_partkey % 2 = 0 AS cantrip, 'Evocación' AS school, 'Mago|' || p_brand AS classes FROM part""")
def spell_subtitle(spark, sf_dir):
    s = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Truco de evocación (Mago, "), "p_brand", F.lit(")"))).otherwise(F.concat(F.lit("Evocación de nivel "), (F.col("p_size") % 9 + 1).cast("string"), F.lit(" (Mago, "), "p_brand", F.lit(")")))
    a, b, c, d = P.spell_subtitle(s)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("level"), b.alias("cantrip"), c.alias("school"), F.array_join(d, "|").alias("classes"))


@plans.add(r"""SELECT p_partkey, 'Arma' AS category, p_name AS variant, CASE WHEN p_partkey % 2 = 0 THEN 'Muy raro' ELSE 'Raro' END AS rarity, p_partkey % 3 = 0 AS attunement, CASE WHEN p_partkey % 3 = 0 THEN 'un ' || lower(p_brand) END AS attuned_by FROM part""")
def item_subtitle(spark, sf_dir):
    s = F.concat(F.lit("Arma ("), "p_name", F.lit("), "), F.when(F.col("p_partkey") % 2 == 0, "muy rara").otherwise("rara"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" (requiere sintonización con un "), F.lower("p_brand"), F.lit(")"))).otherwise(""))
    a, b, c, d, e = P.item_subtitle(s, {"rara": "Raro", "muy rara": "Muy raro", "comun": "Común"})
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("category"), b.alias("variant"), c.alias("rarity"), d.alias("attunement"), e.alias("attuned_by"))


@plans.add(r"""SELECT n_nationkey, 'col2=' || n_name || '|key=' || CAST(n_nationkey AS VARCHAR) AS fields FROM nation""")
def kv_zip(spark, sf_dir):
    header = F.array(F.lit("key"), F.lit(" "), F.lit("gone"))
    m = P.zipped(header, F.array(F.col("n_nationkey").cast("string"), F.col("n_name"), F.lit("  ")))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"])), "|").alias("fields"))


@plans.add(r"""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'brand=' || p_brand || '|' ELSE '' END || 'name=' || p_name AS fields FROM part""")
def map_filter_blank(spark, sf_dir):
    m = F.map_filter(F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" ")), lambda k, v: F.trim(v) != "")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"])), "|").alias("fields"))


@plans.add(r"""SELECT doc_id, sha256(text) AS sha FROM documents""")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@plans.add(r"""SELECT w AS word, row_number() OVER (ORDER BY w COLLATE es, w) AS place FROM (SELECT DISTINCT unnest(regexp_extract_all(html, '[a-zA-ZáéíóúñÁÉÍÓÚÑ]+')) AS w FROM pages) WHERE regexp_matches(w, '^[a-záéíóúñ]+$')""")
def locale_rank(spark, sf_dir):
    from pyspark.sql import Window as W

    words = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit("[a-zA-ZáéíóúñÁÉÍÓÚÑ]+"), F.lit(0))).alias("word")).distinct().filter(F.col("word").rlike("^[a-záéíóúñ]+$"))
    return words.select("word", F.row_number().over(W.orderBy(F.collate("word", "es"), "word")).cast("bigint").alias("place"))


@plans.add(r"""SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, 'part/' || trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') || '.json' AS path FROM part""")
def path_build(spark, sf_dir):
    key = F.concat(F.lit("part."), X.slugify(F.concat_ws(" ", "p_brand", "p_name")))
    slug = F.substring_index(key, ".", -1)
    return table(spark, sf_dir, "part").select("p_partkey", slug.alias("slug"), F.concat(F.substring_index(key, ".", 1), F.lit("/"), slug, F.lit(".json")).alias("path"))
