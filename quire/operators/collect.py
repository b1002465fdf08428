"""Typed collections from the document tree, their ids, indexes and links."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import parse as P
from quire.functions import text as X
from quire.operators import document as D
from quire.operators import tree
from quire.operators.joins import names_first
from quire.operators.sequence import labelled_slices


@dataclass(frozen=True)
class Words:
    """A language's vocabulary for the collectors."""

    spells: str = "Descripciones de conjuros"
    casting: str = "tiempo de lanzamiento"
    reach: str = "alcance"
    parts: str = "componentes"
    lasting: str = "duracion"
    rarities: dict[str, str] = field(default_factory=lambda: {"comun": "Común", "infrecuente": "Infrecuente", "poco comun": "Poco común", "rara": "Raro", "raro": "Raro", "muy rara": "Muy raro", "muy raro": "Muy raro", "legendaria": "Legendario", "legendario": "Legendario", "artefacto": "Artefacto", "varia": "Varía"})
    items: str = "Objetos mágicos"
    glossary: str = "Glosario de reglas"
    feats: str = "Dotes"
    species: str = "Especies"
    backgrounds: str = "Trasfondos"
    classes: str = "Clases"
    equipment: str = "Equipo"
    monsters: str = "Monstruos"
    subclass: str = "Subclase"


Collector = Callable[[DataFrame, Words], DataFrame]


@dataclass(frozen=True)
class Collection:
    name: str
    prefix: str
    collect: Collector
    index: tuple[str, ...]


def source(book: str = "book") -> Column:
    return F.struct(F.lit(book).alias("book"), F.col("page"), F.when(F.size("pages") > 1, F.col("pages")).alias("pages"))


def with_ids(rows: DataFrame, prefix: str, name: str = "name") -> DataFrame:
    """prefix.slug, numbered by occurrence in document order; a number that is itself a name is passed over."""
    base = F.concat(F.lit(prefix + "."), X.slugify(F.col(name)))
    at = rows.withColumn("__b", base)
    n = F.row_number().over(W.partitionBy("__b").orderBy("pos"))
    taken = rows.select(F.concat(F.lit(prefix + "."), X.slugify(F.col(name))).alias("__id")).distinct()
    at = at.withColumn("__id", F.when(n == 1, F.col("__b")).otherwise(F.concat("__b", F.lit("-"), n.cast("string")))).withColumn("__n", n)
    clash = at.filter("__n > 1").join(taken, "__id", "left_semi").select("__id").distinct().withColumn("__c", F.lit(True))
    got = at.join(clash, "__id", "left").withColumn("id", F.when(F.col("__c") & (F.col("__n") > 1), F.concat("__id", F.lit("-bis"))).otherwise(F.col("__id")))
    return got.drop("__b", "__id", "__n", "__c")


def _property(children: Column, key: str) -> Column:
    """The value of the leading properties' one with this label."""
    props = F.filter(children, lambda c: c["type"] == "property")
    return F.get(F.transform(F.filter(props, lambda c: X.sort_key(c["label"]) == key), lambda c: c["value"]), F.lit(0))


def _subtitle(children: Column) -> Column:
    return F.get(F.transform(F.filter(children, lambda c: c["type"] == "subtitle"), lambda c: c["text"]), F.lit(0))


def spells(nodes: DataFrame, words: Words) -> DataFrame:
    at = D.entries(nodes, "entry", words.spells).withColumn("sub", _subtitle(F.col("children")))
    level, trick, school, classes = P.spell_subtitle(F.col("sub"))
    for name, key in (("t", words.casting), ("r", words.reach), ("c", words.parts), ("d", words.lasting)):
        at = at.withColumn(name, _property(F.col("children"), key))
    at = at.filter(F.col("sub").isNotNull() & F.col("t").isNotNull() & F.col("r").isNotNull() & F.col("c").isNotNull() & F.col("d").isNotNull()).withColumns({"level": level, "cantrip": trick, "school": school, "classes": classes}).filter("level is not null")
    kind, ritual, value, unit, trigger = P.casting_time(F.col("t"))
    reach, meters, shape = P.reach(F.col("r"))
    v, s, m, material, consumed = P.components(F.col("c"))
    conc, dkind, dvalue, dunit = P.duration(F.col("d"))
    rest = ["subtitle", "property"]
    return at.select(
        "pos", F.col("title").alias("name"), "level", "cantrip", "school", "classes", ritual.alias("ritual"), conc.alias("concentration"),
        F.struct(F.col("t").alias("raw"), kind.alias("kind"), ritual.alias("ritual"), value.alias("value"), unit.alias("unit"), trigger.alias("trigger")).alias("castingTime"),
        F.struct(F.col("r").alias("raw"), reach.alias("kind"), meters.alias("meters"), shape.alias("shape")).alias("range"),
        F.struct(F.col("c").alias("raw"), v.alias("v"), s.alias("s"), m.alias("m"), material.alias("material"), consumed.alias("consumed")).alias("components"),
        F.struct(F.col("d").alias("raw"), conc.alias("concentration"), dkind.alias("kind"), dvalue.alias("value"), dunit.alias("unit")).alias("duration"),
        D.plain(F.col("children"), rest).alias("text"), D.content(F.col("children"), rest).alias("blocks"), source().alias("source"),
    )


def magic_items(nodes: DataFrame, words: Words) -> DataFrame:
    at = D.entries(nodes, "entry", words.items).filter(F.get(F.col("children"), F.lit(0))["type"] == "subtitle").withColumn("subtitle", _subtitle(F.col("children")))
    category, variant, rarity, tuned, by = P.item_subtitle(F.col("subtitle"), words.rarities)
    return at.select("pos", F.col("title").alias("name"), category.alias("category"), variant.alias("variant"), rarity.alias("rarity"), tuned.alias("attunement"), by.alias("attunementRequires"), "subtitle", D.plain(F.col("children"), ["subtitle"]).alias("text"), D.content(F.col("children"), ["subtitle"]).alias("blocks"), source().alias("source"))


def _simple(under: Callable[[Words], str], extra: Callable[[DataFrame], dict[str, Column]] = lambda _: {}) -> Collector:
    def collect(nodes: DataFrame, words: Words) -> DataFrame:
        at = D.entries(nodes, "entry", under(words)).filter("children is not null")
        more = extra(at)
        name = more.pop("name", F.col("title"))
        return at.select("pos", name.alias("name"), *[c.alias(k) for k, c in more.items()], D.plain(F.col("children"), []).alias("text"), D.content(F.col("children"), []).alias("blocks"), source().alias("source"))

    return collect


def _glossary(_: DataFrame) -> dict[str, Column]:
    name, kind = P.bracket_kind(F.col("title"))
    return {"name": name, "kind": kind}


def tables(nodes: DataFrame, words: Words) -> DataFrame:
    at = nodes.filter("type = 'table'").withColumn("pages", F.array("page"))
    name = F.coalesce("caption", F.try_element_at("path", F.lit(-1)), F.lit("tabla"))
    return at.select("pos", name.alias("name"), "caption", "header", "rows", F.slice("path", 2, 99).alias("context"), source().alias("source"))


def sidebars(nodes: DataFrame, words: Words) -> DataFrame:
    at = D.entries(nodes, "sidebar")
    return at.select("pos", F.coalesce("title", F.lit("recuadro")).alias("name"), F.col("title"), D.content(F.col("children"), ["sidebar_title"]).alias("blocks"), F.slice("path", 2, 99).alias("context"), source().alias("source"))


def classes(nodes: DataFrame, words: Words) -> DataFrame:
    """Sections of the classes chapter: traits from the first two-column table, progression, features by level with their subclass."""
    heads = nodes.filter(F.array_contains("path", words.classes) & (F.col("type") == "section"))
    below = nodes.filter("parent_id is not null and md is not null").groupBy("doc", F.col("parent_id").alias("node_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "md"))), lambda x: F.struct(x["md"].alias("md"))).alias("said"))
    under = nodes.join(below, ["doc", "node_id"], "left").select(F.col("path").alias("p"), F.col("pos").alias("q"), "type", "title", "caption", "header", "rows", F.col("page").alias("fp"), "said")
    at = heads.select("pos", F.col("title").alias("name"), "page").join(under, F.array_contains("p", F.col("name")), "left")
    level, feature = P.level_title(F.col("title"))
    subclass = F.get(F.filter("p", lambda x: x.startswith(words.subclass)), F.lit(0))
    isfeat = level.isNotNull()
    two = (F.col("type") == "table") & (F.size("header") == 0)
    traits = F.min_by(F.when(two, F.col("rows")), F.when(two, F.col("q")))
    grown = (F.col("type") == "table") & (F.size("header") > 2)
    steps = F.min_by(F.when(grown, F.struct("caption", "header", "rows")), F.when(grown, F.col("q")))
    item = F.when(isfeat, F.struct(subclass.isNotNull().alias("o"), F.coalesce(subclass, F.lit("")).alias("subclass"), level.alias("level"), F.col("q").alias("pos"), feature.alias("name"), F.col("title"), F.col("fp").alias("page"), F.col("said").alias("blocks")))
    got = at.groupBy("pos", "name", "page").agg(traits.alias("t"), steps.alias("progression"), F.array_sort(F.collect_list(item)).alias("all"))
    pair = F.transform(F.filter("t", lambda r: F.size(r) > 1), lambda r: F.struct(r[0].alias("k"), r[1].alias("v")))
    feats = lambda cond: F.transform(F.filter("all", cond), lambda f: F.struct(f["level"].alias("level"), f["name"].alias("name"), f["subclass"].alias("subclass"), f["page"].alias("page"), f["blocks"].alias("blocks")))
    names = F.array_distinct(F.transform(F.filter("all", lambda f: f["o"]), lambda f: f["subclass"]))
    return got.withColumn("pages", F.array("page")).select(
        "pos", "name", F.coalesce(F.map_from_entries(pair), F.create_map().cast("map<string,string>")).alias("coreTraits"), "progression", feats(lambda f: ~f["o"]).alias("features"),
        F.transform(names, lambda n: F.struct(n.alias("name"), F.transform(F.filter("all", lambda f: f["subclass"] == n), lambda f: F.struct(f["level"].alias("level"), f["name"].alias("name"), f["blocks"].alias("blocks"))).alias("features"))).alias("subclasses"), source().alias("source"),
    )


def equipment(nodes: DataFrame, words: Words) -> DataFrame:
    """Rows of the chapter's tables with price and weight, group rows filled forward, and entries with a price in their title; descriptions by slug."""
    from quire.operators.sequence import fill_forward

    t = nodes.filter((F.col("type") == "table") & F.array_contains("path", words.equipment) & (F.size("header") > 1))
    rows = t.select(F.col("pos").alias("tpos"), "caption", "header", "page", F.posexplode("rows").alias("rpos", "row"))
    filled = F.filter("row", lambda c: F.trim(c) != "")
    group = (F.size(filled) == 1) & (F.size("row") > 1)
    rows = fill_forward(rows.withColumn("is_group", group).withColumn("g", F.when(group, F.get(filled, F.lit(0)))), ["tpos"], ["rpos"], F.col("g"), "group").filter(~F.col("is_group") & (F.size(filled) > 0))
    fields = P.zipped(F.col("header"), F.col("row"))
    rows = rows.select((F.col("tpos") * 10000 + F.col("rpos")).alias("pos"), F.trim(F.get("row", F.lit(0))).alias("name"), "group", F.col("caption").alias("table"), fields.alias("fields"), "page")
    titled = D.entries(nodes, "entry", words.equipment)
    name, cost = P.title_price(F.col("title"))
    priced = titled.withColumns({"n2": name, "cost": cost})
    texts = priced.select(F.explode(F.array_distinct(F.array(X.slugify(F.col("n2")), X.slugify(X.without_parens(F.col("title")))))).alias("slug"), "pos", D.plain(F.col("children"), []).alias("text"), F.col("page").alias("descriptionPage"))
    described = names_first(texts, "slug", ["pos"]).select("slug", "text", "descriptionPage")
    own = priced.filter("cost is not null").select((F.col("pos") * 10000).alias("pos"), F.col("n2").alias("name"), F.lit(None).cast("string").alias("group"), F.lit(None).cast("string").alias("table"), F.create_map(F.lit("Coste"), F.col("cost")).alias("fields"), "page")
    all_rows = rows.unionByName(own).withColumn("slug", X.slugify(F.col("name"))).join(described, "slug", "left")
    find = lambda pattern: F.get(F.map_values(F.map_filter("fields", lambda k, v: X.sort_key(k).rlike(pattern))), F.lit(0))
    amount, coin, gp = P.price(find("^(coste|precio)"))
    kg = P.weight(find("^peso"))
    return all_rows.withColumn("pages", F.array("page")).select(
        "pos", "name", F.coalesce("table", F.lit("item")).alias("kind"), "group", "table", "fields", F.when(amount.isNotNull(), F.struct(find("^(coste|precio)").alias("raw"), amount.alias("amount"), coin.alias("coin"), gp.alias("gp"))).alias("price"),
        F.when(kg.isNotNull(), F.struct(find("^peso").alias("raw"), kg.alias("kg"))).alias("weight"), "text", "descriptionPage", source().alias("source"),
    )


#: Labels in a stat block's header lines, fixed values.
STATS = {
    "ca": "CA:", "iniciativa": "Iniciativa:", "pg": "PG:", "velocidad": "Velocidad:", "habilidades": "Habilidades:", "sentidos": "Sentidos:", "idiomas": "Idiomas:",
    "inmunidades": "Inmunidades:", "resistencias": "Resistencias:", "vulnerabilidades": "Vulnerabilidades:", "equipo": "Equipo:", "vd": "VD:",
}


def monsters(nodes: DataFrame, words: Words) -> DataFrame:
    """Stat blocks: nodes of type statblock whose children are the meta line, properties, ability lines, section marks and run-in entries."""
    at = D.entries(nodes, "statblock").withColumn("meta", F.get(F.transform(F.filter("children", lambda c: c["type"] == "meta"), lambda c: c["text"]), F.lit(0)))
    kind, size, alignment, tags = P.meta_line(F.col("meta"))
    heads = F.array_join(F.transform(F.filter("children", lambda c: c["type"] == "header"), lambda c: c["text"]), " ")
    at = at.withColumn("stats", labelled_slices(heads, list(STATS.values())))
    at = at.withColumns({f"stat_{key}": F.coalesce(_property(F.col("children"), key), F.try_element_at("stats", F.lit(label))) for key, label in STATS.items()})
    prop = lambda key: F.col(f"stat_{key}")
    average, formula = P.hit_points(prop("pg"))
    mod, score = P.initiative(prop("iniciativa"))
    cr, xp, bonus, lair = P.challenge(prop("vd"))
    ability = F.array_join(F.transform(F.filter("children", lambda c: c["type"] == "ability"), lambda c: c["text"]), " ")
    # sections run from one mark to the next
    marked = F.aggregate("children", F.expr("struct('' as s, cast(array() as array<struct<s: string, md: string, page: int>>) as out)"), lambda acc, c: F.when(c["type"] == "section_mark", F.struct(X.sort_key(c["text"]).alias("s"), acc["out"].alias("out"))).when((c["type"] == "paragraph") | ((c["type"] == "meta") & (acc["s"] != "")), F.struct(acc["s"].alias("s"), F.concat(acc["out"], F.array(F.struct(acc["s"].alias("s"), c["md"].alias("md"), c["page"].alias("page")))).alias("out"))).otherwise(acc), lambda acc: acc["out"])

    def section(name: str) -> Column:
        def entry(e):
            title, rest = X.split_runin(e["md"])
            name, used = P.uses(title)
            return F.struct(name.alias("name"), e["md"].alias("md"), e["page"].alias("page"), rest.alias("description"), used.alias("uses"))

        return F.transform(F.filter("marked", lambda e: e["s"] == name), entry)

    legendary = section("acciones legendarias")
    intro = F.get(F.transform(F.filter(legendary, lambda e: e["name"].isNull()), lambda e: e["md"]), F.lit(0))
    used, in_lair = P.legendary_uses(intro)
    listed = lambda key: F.coalesce(X.list_split(prop(key)), F.array().cast("array<string>"))
    return at.withColumn("marked", marked).select(
        "pos", F.col("title").alias("name"), F.slice("path", 2, 99).alias("context"), F.col("meta").alias("metaRaw"), kind.alias("type"), size.alias("size"), alignment.alias("alignment"), tags.alias("tags"),
        P.number(prop("ca")).alias("ac"), prop("ca").alias("acRaw"), F.struct(mod.alias("mod"), score.alias("score")).alias("initiative"), F.struct(prop("pg").alias("raw"), average.alias("average"), formula.alias("formula")).alias("hp"),
        P.speeds(F.coalesce(prop("velocidad"), F.lit(""))).alias("speeds"), P.signed_map(F.coalesce(prop("habilidades"), F.lit(""))).alias("skills"), F.struct(prop("sentidos").alias("raw"), F.nullif(F.regexp_extract(F.coalesce(prop("sentidos"), F.lit("")), r"(?i)percepci[oó]n pasiva (\d+)", 1), F.lit("")).cast("int").alias("passivePerception")).alias("senses"),
        listed("idiomas").alias("languages"), listed("inmunidades").alias("immunities"), listed("resistencias").alias("resistances"), listed("vulnerabilidades").alias("vulnerabilities"), listed("equipo").alias("gear"),
        F.struct(prop("vd").alias("raw"), cr.alias("cr"), xp.alias("xp"), lair.alias("xpInLair"), bonus.alias("proficiencyBonus")).alias("challenge"), P.abilities(ability).alias("abilities"),
        section("atributos").alias("traits"), section("acciones").alias("actions"), section("acciones adicionales").alias("bonusActions"), section("reacciones").alias("reactions"),
        F.struct(F.filter(legendary, lambda e: e["name"].isNotNull()).alias("actions"), intro.alias("intro"), used.alias("uses"), in_lair.alias("usesInLair")).alias("legendary"), source().alias("source"),
    )


#: The registry: adding a collection is adding a row.
COLLECTIONS = (
    Collection("spells", "spell", spells, ("id", "name", "level", "school", "classes", "ritual", "concentration")),
    Collection("monsters", "monster", monsters, ("id", "name", "size", "type", "alignment", "ac", "challenge")),
    Collection("magic-items", "item", magic_items, ("id", "name", "category", "variant", "rarity", "attunement")),
    Collection("classes", "class", classes, ("id", "name")),
    Collection("equipment", "equipment", equipment, ("id", "name", "kind", "group", "price", "weight")),
    Collection("rules-glossary", "rule", _simple(lambda w: w.glossary, _glossary), ("id", "name", "kind")),
    Collection("feats", "feat", _simple(lambda w: w.feats, lambda _: {"category": F.try_element_at("path", F.lit(-1))}), ("id", "name", "category")),
    Collection("species", "species", _simple(lambda w: w.species), ("id", "name")),
    Collection("backgrounds", "background", _simple(lambda w: w.backgrounds), ("id", "name")),
    Collection("tables", "table", tables, ("id", "caption", "context")),
    Collection("sidebars", "sidebar", sidebars, ("id", "title", "context")),
)


def collect(nodes: DataFrame, words: Words | None = None, only: list[str] | None = None) -> dict[str, DataFrame]:
    """All collections by name, each lazily; cache or store nodes first, every collector reads them."""
    return {c.name: with_ids(c.collect(nodes, words or Words()), c.prefix) for c in COLLECTIONS if only is None or c.name in only}


def index_of(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The listed fields that the rows have, and the page."""
    return rows.select(*[c for c in fields if c in rows.columns], F.col("source.page").alias("page"))


def by_id(collections: dict[str, DataFrame]) -> DataFrame:
    """(id, collection, name, page, path, pos) of all records; of records with one id the last counts."""
    out = None
    for k, (name, rows) in enumerate(collections.items()):
        one = rows.select("id", F.lit(name).alias("collection"), "name", F.col("source.page").alias("page"), F.concat(F.lit(name + "/"), F.substring_index("id", ".", -1), F.lit(".json")).alias("path"), "pos", F.lit(k).alias("at"))
        out = one if out is None else out.unionByName(one)
    fields = ("collection", "name", "page", "path", "pos")
    last = out.groupBy("id").agg(F.max_by(F.struct(*fields), F.struct("at", "pos")).alias("r"))
    return last.select("id", *[F.col(f"r.{c}").alias(c) for c in fields])


def by_page(index: DataFrame) -> DataFrame:
    """(page, ids), both in order."""
    return index.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("collection", "pos", "id"))), lambda x: x["id"]).alias("ids"))


#: Where a record's blocks are, in the order in which they are read.
SECTIONS = ("blocks", "traits", "actions", "bonusActions", "reactions")


def _blocks(rows: DataFrame) -> list[tuple[str, Column]]:
    md = lambda blocks: F.transform(F.filter(blocks, lambda b: b["md"].isNotNull()), lambda b: F.struct(b["md"].alias("md")))
    within = lambda features: F.flatten(F.transform(features, lambda f: F.coalesce(md(f["blocks"]), F.array().cast("array<struct<md: string>>"))))
    out = [(c, md(F.col(c))) for c in SECTIONS if c in rows.columns]
    if "legendary" in rows.columns:
        out.append(("legendary", md(F.col("legendary.actions"))))
    if "subclasses" in rows.columns:
        out.append(("subclasses", F.flatten(F.transform("subclasses", lambda s: within(s["features"])))))
    if "features" in rows.columns:
        out.append(("features", within(F.col("features"))))
    return out


def mentions(collections: dict[str, DataFrame]) -> DataFrame:
    """(source, pos, key): emphasised texts in all blocks of records, in order, labels left out."""
    out = None
    for rows in collections.values():
        groups = _blocks(rows)
        if not groups:
            continue
        md = F.flatten(F.transform(tree.enumerated(groups), lambda b: X.emphasised(b["md"])))
        one = rows.select(F.col("id").alias("source"), F.posexplode(md).alias("pos", "t")).filter(~X.is_label(F.col("t"), ["nota", "ver"])).select("source", "pos", X.slugify(F.col("t")).alias("key"))
        out = one if out is None else out.unionByName(one)
    return out


def crossrefs(collections: dict[str, DataFrame], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Links (source, target, pos) and unresolved keys with counts; names of earlier collections come first."""
    from quire.operators.joins import resolve, unresolved

    names = None
    for k, name in enumerate(n for n in order if n in collections):
        one = collections[name].select(X.slugify(F.col("name")).alias("key"), F.col("id").alias("target"), F.lit(k).alias("prio"), F.col("pos").alias("at"))
        names = one if names is None else names.unionByName(one)
    said = mentions(collections)
    return resolve(said, names, "key", "source", "target", ["prio", "at"]), unresolved(said, names, "key")
