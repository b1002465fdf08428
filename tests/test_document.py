"""From blocks to collections, exports and streams, on invented text."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.operators import collect as C
from quire.operators import document as D
from quire.operators import joins as J
from quire.operators import search as Q
from quire.operators import tree as T
from quire.operators import validate as V
from quire.sources import sinks
from quire.streaming import pages as P

SPELLS = "Descripciones de conjuros"


def blocks():
    out = []

    def add(kind, text="", level=None, md=None, page=1, header=None, rows=None, caption=None):
        out.append(("book", len(out), kind, level, text, md, page, None, header, rows, caption))

    add("paragraph", "before")
    add("heading", "Conjuros", 1)
    add("heading", SPELLS, 2)
    for name, level in (("Bola áurea", 3), ("Truco gris", 0), ("Bola áurea", 1)):
        add("heading", name, 4, page=2)
        add("subtitle", f"Evocación de nivel {level} (Mago, Brujo)" if level else "Truco de evocación (Mago)", page=2)
        for label, value in (("Tiempo de lanzamiento", "Acción"), ("Alcance", "18 m"), ("Componentes", "V, S"), ("Duración", "Concentración, hasta 1 minuto")):
            add("property", f"{label}: {value}", page=2)
        add("paragraph", "Golpea como un martillo.", md="Golpea como *Martillo gris*, mira *Truco gris* y *Nada*.", page=3)
    add("heading", "Objetos", 1, page=4)
    add("heading", "Objetos mágicos", 2, page=4)
    add("heading", "Martillo gris", 4, page=5)
    add("subtitle", "Arma (martillo), muy rara (requiere sintonización con un mago)", page=5)
    add("paragraph", "Pesa.", page=5)
    add("heading", "Equipo", 1, page=6)
    add("table", caption="Armas", header=["Nombre", "Coste", "Peso"], rows=[["Simples", "", ""], ["Daga", "2 po", "0,5 kg"], ["Maza", "5 po", "2 kg"]], page=6)
    add("heading", "Glosario de reglas", 1, page=7)
    add("heading", "Ciego [estado]", 4, page=7)
    add("paragraph", "No ve.", page=7)
    add("callout", "Ojo", page=7)
    return out


@pytest.fixture(scope="module")
def nodes(spark):
    return D.nodes(spark.createDataFrame(blocks(), D.BLOCK)).cache()


def test_tree_paths_and_ids(nodes):
    got = {(r.node_id): r for r in nodes.collect()}
    assert got["bola-aurea"].path == ["Conjuros", SPELLS] and got["bola-aurea-2"].parent_id == "descripciones-de-conjuros"
    assert got["objetos"].path == [] and got["martillo-gris"].path == ["Objetos", "Objetos mágicos"]
    assert got["~0"].parent_id is None and got["ciego-estado"].path == ["Glosario de reglas"]
    prop = next(r for r in got.values() if r.label == "Alcance")
    assert (prop.value, prop.path[-1]) == ("18 m", "Bola áurea")


def test_collections(nodes):
    got = C.collect(nodes)
    spells = {r.id: r for r in got["spells"].collect()}
    assert sorted(spells) == ["spell.bola-aurea", "spell.bola-aurea-2", "spell.truco-gris"]
    s = spells["spell.bola-aurea"]
    assert (s.level, s.cantrip, s.school, s.classes, s.range.meters, s.duration.unit, s.concentration) == (3, False, "Evocación", ["Mago", "Brujo"], 18.0, "minuto", True)
    assert s.source.page == 2 and s.source.pages == [2, 3] and spells["spell.truco-gris"].level == 0
    item = got["magic-items"].first()
    assert (item.category, item.variant, item.rarity, item.attunement, item.attunementRequires) == ("Arma", "martillo", "Muy raro", True, "un mago")
    gear = {r.name: r for r in got["equipment"].collect()}
    assert gear["Daga"].group == "Simples" and gear["Daga"].price.gp == 2.0 and gear["Maza"].weight.kg == 2.0
    assert [(r.name, r.kind) for r in got["rules-glossary"].collect()] == [("Ciego", "estado")]
    assert got["tables"].first().caption == "Armas"
    for name in ("monsters", "classes", "feats", "species", "backgrounds", "sidebars"):
        assert got[name].count() == 0


def test_links_and_indexes(nodes):
    got = C.collect(nodes, only=["spells", "magic-items"])
    links, missing = C.crossrefs(got, ["spells", "magic-items"])
    assert {(r.source, r.target) for r in links.collect()} == {(f"spell.{s}", t) for s in ("bola-aurea", "bola-aurea-2", "truco-gris") for t in ("item.martillo-gris", "spell.truco-gris")} - {("spell.truco-gris", "spell.truco-gris")}
    assert [(r.key, r.n) for r in missing.collect()] == [("nada", 3)]
    index = C.by_id(got)
    assert {r.path for r in index.collect()} >= {"spells/bola-aurea.json"} and {r.page: r.ids for r in C.by_page(index).collect()}[5] == ["item.martillo-gris"]
    assert V.duplicate_ids(index.select("id")).count() == 0


def test_exports(spark, nodes, tmp_path):
    got = C.collect(nodes, only=["spells", "magic-items"])
    sinks.write_collection(got["spells"], str(tmp_path), "spells", C.COLLECTIONS[0].index)
    assert json.loads((tmp_path / "spells.records/bola-aurea.json").read_text())["level"] == 3
    assert spark.read.json(f"{tmp_path}/spells.index").columns == ["classes", "concentration", "id", "level", "name", "page", "ritual", "school"]
    links, _ = C.crossrefs(got, ["spells", "magic-items"])
    rows = sinks.entities(got)
    sinks.write_database(rows, links, f"{tmp_path}/x.sqlite")
    db = sqlite3.connect(f"{tmp_path}/x.sqlite")
    assert db.execute("SELECT id FROM search WHERE search MATCH 'aurea' ORDER BY rank LIMIT 1").fetchone()[0].startswith("spell.bola-aurea")
    assert db.execute("SELECT count(*) FROM entity WHERE json_extract(data, '$.level') = 3").fetchone() == (1,)
    assert db.execute("SELECT count(*) FROM ref WHERE target = 'item.martillo-gris'").fetchone() == (3,)
    index = Q.postings(rows, "id", ["name", "body"])
    assert {r.id for r in Q.ranked(index, ["martillo", "gris"], every=True).collect()} >= {"item.martillo-gris"}
    names = sinks.write_schemas(got, f"{tmp_path}/schemas")
    schema = json.loads((tmp_path / "schemas" / names[0]).read_text())
    assert "level" in schema["items"]["required"] and schema["items"]["properties"]["school"]["enum"] == ["Evocación"]
    text = T.markdown(nodes.filter("type != 'table'").select("doc", "pos", "type", "title", "md"), "doc").select(F.lit(1).alias("no"), F.lit("libro").alias("slug"), "text")
    assert sinks.write_markdown(text, f"{tmp_path}/md") == ["01-libro.md"]
    made = (tmp_path / "md/01-libro.md").read_text()
    assert "# Conjuros" in made and "> Ojo" in made and "\n\n\n" not in made


def line(seq, text, y, x0=0.0, role="body", **more):
    return {"seq": seq, "text": text, "y": float(y), "x0": x0, "x1": 100.0, "role": role, "column": 0, "region": None, "size": 10.0, "level": None, "bold": False} | more


def test_block_fold():
    fold = lambda *lines: [(b["kind"], b["text"]) for b in B.fold_page(lines)]
    assert fold(line(0, "Big", 0, role="section"), line(1, "title", 15, role="section"), line(2, "text", 40)) == [("heading", "Big title"), ("paragraph", "text")]
    assert fold(line(0, "a ha­", 0), line(1, "lf", 12), line(2, "far", 60)) == [("paragraph", "a half"), ("paragraph", "far")]
    assert fold(line(0, "one", 0), line(1, "in", 12, x0=8.0), line(2, "on", 24, x0=8.0)) == [("paragraph", "one"), ("paragraph", "in on")]
    assert fold(line(0, "• a", 0), line(1, "more", 12), line(2, "• b", 24), line(3, "1: step", 36)) == [("bullet", "• a more"), ("bullet", "• b"), ("step", "1: step")]
    assert fold(line(0, "Bold run", 0, bold=True, bold_open=True), line(1, "in. Text", 12, bold=True), line(2, "New. x", 24, bold=True)) == [("definition", "Bold run in. Text"), ("definition", "New. x")]
    assert fold(line(0, "t", 0, role="table.cell", region="table0"), line(1, "u", 90, role="table.cell", region="table0"), line(2, "v", 95, role="table.cell", region="table1")) == [("table", "t u"), ("table", "v")]


def test_stitch(spark):
    rows = [("d", 0, 1, "cut"), ("d", 1, 2, "here."), ("d", 2, 3, "new"), ("d", 3, 3, "same page")]
    got = B.stitched(spark.createDataFrame(rows, "doc string, seq int, page int, text string"), ["doc"], ["seq"], "text", ["page"])
    assert [r.text for r in got.orderBy("run").collect()] == ["cut here.", "new", "same page"]
    rows = [("d", 0, 1, "one"), ("d", 1, 2, "two"), ("d", 2, 2, "three"), ("d", 3, 3, "four."), ("d", 4, 3, "five")]
    got = B.stitched(spark.createDataFrame(rows, "doc string, seq int, page int, text string"), ["doc"], ["seq"], "text", ["page"])
    assert [r.text for r in got.orderBy("run").collect()] == ["one two three four.", "five"]


def test_groups_of_blocks(spark):
    made = [("heading", "Beasts", 1, 1, None), ("statblock.body", "stray", None, 1, None), ("paragraph", "p", None, 1, None), ("statblock.name", "Wolf", None, 1, None), ("statblock.meta", "m", None, 1, None), ("statblock.name", "Bear", None, 2, None), ("statblock.body", "b", None, 2, None), ("heading", "Tip", 2, 2, "sidebar0"), ("sidebar_title", "Box", None, 2, "sidebar0"), ("sidebar_body", "in", None, 2, "sidebar0"), ("sidebar_body", "other", None, 2, "sidebar1"), ("toc", "A long", None, 3, None), ("toc", "title .... 12", None, 3, None), ("toc", "B .... 3", None, 4, None), ("odd", "lost", None, 5, None), ("paragraph", "after", None, 5, None)]
    frame = spark.createDataFrame([("d", i, k, lv, t, None, page, region, None, None, None) for i, (k, t, lv, page, region) in enumerate(made)], D.BLOCK)
    got = D.nodes(frame).orderBy("pos", F.col("parent_id").isNotNull()).collect()
    told = [(r.type, r.title or r.text, r.parent_id) for r in got]
    assert ("statblock", "Wolf", "beasts") in told and ("meta", "m", "wolf") in told and ("statblock", "Bear", "beasts") in told and ("paragraph", "b", "bear") in told
    assert ("sidebar", "Box", "beasts") in told and ("paragraph", "Tip", "box") in told and ("paragraph", "in", "box") in told and ("paragraph", "after", "beasts") in told
    assert next(r.path for r in got if r.text == "in") == ["Beasts", "Box"]
    assert [(r.rows, r.parent_id) for r in got if r.type == "toc"] == [([["A long title", "12"]], "beasts"), ([["B", "3"]], "beasts")]
    assert len({r.node_id for r in got}) == len(got) and not any(r.text in ("stray", "lost") for r in got)
    assert {r.kind: r.n for r in D.dropped(frame).collect()} == {"statblock.body": 1, "odd": 1}


def test_contents(spark):
    lines = [(1, 0, 0, "A long"), (1, 0, 1, "title .... 12"), (1, 0, 2, "Tail"), (1, 1, 0, "Other …… 3")]
    got = D.contents(spark.createDataFrame(lines, "page int, column int, seq int, text string"))
    assert [(r.title, r.target) for r in got.orderBy("column", "seq").collect()] == [("A long title", 12), ("Tail", None), ("Other", 3)]


def test_snapshots_over_versions(spark):
    ids = lambda *x: spark.createDataFrame([(i, p) for i, p in x], "id string, place string")
    now = spark.createDataFrame([], "id string, place string, since string, retired string")
    for version, seen in (("1", [("a", "x"), ("b", "x")]), ("2", [("a", "y")]), ("3", [("a", "y")]), ("4", [("a", "y"), ("b", "x")])):
        now = J.snapshot_diff(now.select("id", "place", "since", "retired"), ids(*seen), "id", "place", version)
        got = {r.id: (r.status, r.since, r.retired) for r in now.collect()}
        assert got["b"] == {"1": ("added", "1", None), "2": ("retired", "1", "2"), "3": ("retired", "1", "2"), "4": ("returned", "1", None)}[version]
    assert got["a"][0] == "kept"


def test_streams(spark, tmp_path):
    rows = [(1, 1.0, 1.0, [("hi", "F", 9.0, 0, 0, 1.0, 1.0, [])], [])]
    spark.createDataFrame(rows, P.PAGE).write.json(f"{tmp_path}/in")
    query = P.style_counts(P.stream_pages(spark, f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName("styles").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.f, r.n) for r in spark.table("styles").collect()] == [("F", 1)]
    events = spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:30:00"), ("u", "2024-01-01 02:00:00")], "user string, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in P.sessions(events, "ts", ["user"]).collect()) == [1, 2]
    spark.createDataFrame([("a", "x")], "id string, place string").write.json(f"{tmp_path}/ids")
    ids = spark.readStream.schema("id string, place string").json(f"{tmp_path}/ids")
    query = P.keep_snapshot(ids, f"{tmp_path}/snap", "1", f"{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.id, r.status) for r in spark.read.parquet(f"{tmp_path}/snap/0").collect()] == [("a", "added")]


def test_verdict_and_report(spark):
    checks = V.compare(spark.createDataFrame([("a", 1), ("b", 2)], "name string, expected bigint"), spark.createDataFrame([("a", 1), ("b", 3)], "name string, actual bigint"))
    assert tuple(V.verdict(checks).first()) == (2, 1, False)
    text, ok = V.report("Checks", checks)
    assert not ok and "| b | 2 | 3 | FAIL |" in text


def test_nested_schema(spark):
    from quire.operators import profile as R

    kind = "id string, `a.b` int, parts array<struct<type: string, n: double, at: array<int>>>, notes map<string, string>"
    rows = [("x", 1, [("t", 1.5, [1, None]), ("u", None, [])], {"k.1": "v"}), ("y", None, [("t", 2.0, [3])], {}), ("z", None, None, None)]
    leaf = R.nested_leaves(spark.createDataFrame(rows, kind), ["id", "a.b", "parts", "notes"]).filter("type != 'null' OR endswith(path, '[]')")
    got = json.loads(R.json_schema("t", R.profile(leaf), R.enumerations(leaf), len(rows)))["items"]
    assert got["required"] == ["id"] and got["properties"]["a.b"] == {"type": "integer"}
    part = got["properties"]["parts"]["items"]
    assert part["required"] == ["at", "type"] and part["properties"]["type"] == {"type": "string", "enum": ["t", "u"]}
    assert part["properties"]["at"] == {"type": "array", "items": {"type": ["integer", "null"]}} and part["properties"]["n"] == {"type": "number"}
    assert got["properties"]["notes"]["properties"] == {"k.1": {"type": "string", "enum": ["v"]}}
    empty = R.nested_leaves(spark.createDataFrame([], kind), ["id", "parts"])
    assert json.loads(R.json_schema("t", R.profile(empty), R.enumerations(empty), 0))["items"] == {"type": "object"}


def test_walk_of_many_nodes(spark):
    many = spark.range(1_000_500)
    nodes = many.select(F.col("id").cast("string").alias("node_id"), F.when(F.col("id") > 0, "0").alias("parent_id"), F.col("id").alias("pos"), F.lit("x").alias("type"), F.lit("t").alias("title"))
    assert T.walk(spark, nodes).agg(F.count("*"), F.max("depth")).first() == (1_000_500, 1)
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and "nodes" in t.name]
