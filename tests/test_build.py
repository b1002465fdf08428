"""Raw pages to exports, end to end, on two invented pages."""

import json
import sqlite3

from quire import build
from quire.sources import pages as S
from tests.test_layout import rect, span

CONFIG = {
    "colors": {"black": 0},
    "rules": [
        {"role": "chapter", "font": "Head", "size": 20, "color": "black", "level": 1}, {"role": "section", "font": "Head", "size": 16, "color": "black", "level": 2}, {"role": "entry", "font": "Head", "size": 12, "color": "black", "level": 4},
        {"role": "subtitle", "font": "Slant", "size": 9, "color": "black"}, {"role": "prop.value", "font": "Prop", "size": 9, "color": "black"}, {"role": "body.italic", "font": "Slant", "size": 8, "color": "black"}, {"role": "body", "font": "Body", "size": 9, "color": "black"},
        {"role": "table.caption", "font": "Cap", "size": 9, "color": "black"}, {"role": "table.header", "font": "Bold", "size": 9, "color": "black"}, {"role": "cell", "font": "Cell", "size": 9, "color": "black"}, {"role": "statblock.name", "font": "SName", "size": 9, "color": "black"}, {"role": "statblock.meta", "font": "SMeta", "size": 9, "color": "black"}, {"role": "statblock.header", "font": "SHead", "size": 9, "color": "black"}, {"role": "statblock.ability", "font": "SAbil", "size": 9, "color": "black"},
        {"role": "statblock.section", "font": "SSect", "size": 9, "color": "black"}, {"role": "body.bold-italic", "font": "BI", "size": 9, "color": "black"}, {"role": "statblock.body", "font": "SBody", "size": 9, "color": "black"}, {"role": "sidebar.title", "font": "Side", "size": 9, "color": "black"},
        {"role": "running-head", "font": "Body", "size": 6, "color": "black", "discard": True},
    ],
    "expected": {"spells": 1, "equipment": 2, "tables": 1, "monsters": 2, "sidebars": 1},
}


def test_build(spark, tmp_path):
    one = [
        span("7", 50, 20, s=6), span("Conjuros", 50, 60, f="Head", s=20), span("Descripciones de conjuros", 50, 90, f="Head", s=16), span("Bola", 50, 120, f="Head", s=12), span("Evocación de nivel 3 (Mago)", 50, 135, f="Slant"),
        span("Tiempo de lanzamiento: Acción", 50, 150, f="Prop"), span("Alcance: 18 m", 50, 162, f="Prop"), span("Componentes: V, S", 50, 174, f="Prop"), span("Duración: Instantánea", 50, 186, f="Prop"),
        span("Arde como ", 50, 210, w=45), span("daga", 96, 210, f="Slant", s=8, w=20), span(" y no", 116, 210, w=20),
    ]
    two = [
        span("para.", 50, 60), span("Equipo", 50, 100, f="Head", s=20), span("Armas", 50, 170, f="Cap"), span("Nombre", 55, 190, f="Bold", w=30), span("Coste", 120, 190, f="Bold", w=25),
        span("Daga", 55, 210, f="Cell", w=20), span("2 po", 120, 210, f="Cell", w=20), span("Maza", 55, 224, f="Cell", w=20), span("5 po", 120, 224, f="Cell", w=20),
    ]
    three = [
        span("Monstruos", 50, 40, f="Head", s=20), span("Lobo", 50, 70, f="SName"), span("Bestia Mediana, sin alineamiento", 50, 84, f="SMeta"), span("CA: 12 Iniciativa: +2 (12)", 50, 98, f="SHead"), span("PG: 11 (2d8 + 2) VD: 1/4 (50 PX; BC +2)", 50, 110, f="SHead"),
        span("Fue 14 +2 +2 Des 15 +2 +2", 50, 130, f="SAbil"), span("Acciones", 50, 150, f="SSect"), span("Muerde como una ", 50, 165, f="SBody", w=75), span("daga", 126, 165, f="Slant", s=8, w=20), span(" y tira.", 146, 165, f="SBody", w=30),
        span("Oso", 50, 200, f="SName"), span("Bestia Grande, sin alineamiento", 50, 214, f="SMeta"), span("Consejo", 60, 420, f="Side"), span("Sin prisa.", 60, 440),
    ]
    pages = spark.createDataFrame([(1, 600.0, 800.0, one, []), (2, 600.0, 800.0, two, [rect(50, 200, 200, 230, 0.9)]), (3, 600.0, 800.0, three, [rect(50, 400, 290, 460, 0.2)])], S.PAGE)
    S.write_pages(pages, f"{tmp_path}/in")
    (tmp_path / "config.json").write_text(json.dumps(CONFIG))
    config = build.load_config(f"{tmp_path}/config.json")
    oks = [build.run(spark, step, f"{tmp_path}/in", f"{tmp_path}/out", config) for step in build.STEPS]
    report = (tmp_path / "out/validation.md").read_text()
    assert all(oks), report
    nodes = spark.read.parquet(f"{tmp_path}/out/nodes").orderBy("pos").collect()
    assert ("chapter", "Equipo") in [(n.type, n.title) for n in nodes] and ("sidebar", "Consejo") in [(n.type, n.title) for n in nodes]
    assert next(n.md for n in nodes if n.type == "paragraph") == "Arde como *daga* y no para."
    table = next(n for n in nodes if n.type == "table")
    assert (table.caption, table.header, table.rows) == ("Armas", ["Nombre", "Coste"], [["Daga", "2 po"], ["Maza", "5 po"]])
    db = sqlite3.connect(tmp_path / "out/book.sqlite")
    assert db.execute("SELECT json_extract(data, '$.price.gp') FROM entity WHERE name = 'Maza'").fetchone() == (5.0,)
    assert sorted(db.execute("SELECT source, target FROM ref").fetchall()) == [("monster.lobo", "equipment.daga"), ("spell.bola", "equipment.daga")]
    wolf, bear = spark.read.parquet(f"{tmp_path}/out/collections/monsters").orderBy("name").collect()
    assert (wolf.name, wolf.size, wolf.ac, wolf.hp.average, wolf.hp.formula, wolf.challenge.cr, wolf.challenge.xp, wolf.challenge.proficiencyBonus) == ("Lobo", "Mediano", 12.0, 11, "2d8 + 2", 0.25, 50, 2)
    assert {k: tuple(v) for k, v in wolf.abilities.items()} == {"fue": (14, 2, 2), "des": (15, 2, 2)} and "*daga*" in wolf.actions[0].md and bear.size == "Grande"
    lock = {r.id: (r.status, r.since) for r in spark.read.parquet(f"{tmp_path}/out/id-lock").collect()}
    assert lock["monster.lobo"] == ("added", "1") and len(lock) == 7
    assert "| Daga | 2 po |" in (tmp_path / "out/markdown/01-equipo.md").read_text()
    before = sorted((f.name, f.read_bytes()) for f in (tmp_path / "out/markdown").iterdir())
    build.run(spark, "export", "", f"{tmp_path}/out", config)
    assert before == sorted((f.name, f.read_bytes()) for f in (tmp_path / "out/markdown").iterdir())
