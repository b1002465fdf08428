"""Synthetic pages, one for each trap of geometry."""

import pytest
from pyspark.sql import functions as F

from quire.operators import layout as L
from quire.operators import tables as T
from quire.operators.sequence import split_threshold
from quire.sources import pages as S

RULES = [(1, "head", "Bold", 14.0, 0, 1, False), (2, "body", "Body", 9.0, 0, None, False), (3, "running-head", "Body", 6.0, 0, None, True), (4, "table.header", "Bold", 9.0, 0, None, False), (5, "cell", "Cell", 9.0, 0, None, False), (6, "body.superscript", "Body", 5.0, 0, None, False)]


def span(t, x, y, f="Body", s=9.0, w=None):
    s = float(s)
    return (t, f, s, 0, 0, float(x), float(y), [float(x), y - s, float(x + (w if w is not None else 5 * len(t))), float(y)])


def pages(spark, *made):
    return spark.createDataFrame([(i, 600.0, 800.0, list(spans), list(rects)) for i, (spans, rects) in enumerate(made, 1)], S.PAGE)


def lines(spark, *made):
    got = L.page_lines(pages(spark, *made), spark.createDataFrame(RULES, L.RULES))
    return [(r.page, r.text, r.column, r.region, r.role) for r in got.orderBy("page", "seq").collect()]


def rect(x0, y0, x1, y1, fill):
    return ("f", [float(x0), float(y0), float(x1), float(y1)], [fill] * 3)


def test_two_columns_share_baselines_and_running_heads_go(spark):
    spans = [span("right one", 320, 100), span("left one", 50, 100), span("left two", 50, 112), span("right two", 320, 112), span("head", 50, 20, s=6.1), span(" ", 10, 10), span("?", 50, 300, f="Odd")]
    assert [x[1:3] for x in lines(spark, (spans, []))] == [("left one", 0), ("left two", 0), ("?", 0), ("right one", 1), ("right two", 1)]


def test_full_width_band_parts_the_page(spark):
    table = rect(40, 200, 560, 260, 0.9)
    spans = [span("L1", 50, 100), span("R1", 320, 100), span("cells", 60, 220, f="Cell"), span("more", 400, 240, f="Cell"), span("L2", 50, 300), span("R2", 320, 300)]
    got = lines(spark, (spans, [table]))
    assert [x[1] for x in got] == ["L1", "R1", "cells", "more", "L2", "R2"] and got[2][2:4] == (-1, "table0")


def test_sidebar_ground_is_no_table(spark):
    found = L.regions(S.rects(pages(spark, ([], [rect(40, 100, 300, 300, 0.2), rect(45, 105, 295, 295, 0.9), rect(40, 400, 300, 500, 0.9), rect(1, 1, 5, 5, 0.9)]))), L.Layout())
    assert sorted((r.kind, r.idx, r.y0) for r in found.collect()) == [("sidebar", 0, 100.0), ("table", 0, 400.0)]


def test_side_tables_stay_apart_and_take_their_headers(spark):
    rects = [rect(50, 200, 150, 260, 0.9), rect(157, 200, 260, 260, 0.9)]
    spans = [span("H1", 55, 180, f="Bold", w=20), span("H2", 160, 180, f="Bold", w=20), span("a", 55, 215, f="Cell", w=8), span("b", 160, 215, f="Cell", w=8)]
    got = {(x[3], x[1]) for x in lines(spark, (spans, rects))}
    assert got == {("table0", "H1"), ("table1", "H2"), ("table0", "a"), ("table1", "b")}


def test_superscript_joins_the_line_below(spark):
    spans = [span("note", 50, 100, w=20), span("2", 70, 97, s=5, w=4), span(" end", 75, 100, w=20)]
    assert [x[1] for x in lines(spark, (spans, []))] == ["note2 end"]


def test_gap_stands_for_a_blank_and_halves_meet(spark):
    spans = [span("two", 50, 100, w=15), span("words", 70, 100, w=25), span("left", 280, 140, w=20), span("right", 305, 140, w=20)]
    assert [x[1] for x in lines(spark, (spans, []))] == ["two words", "left right"]


def test_roles_take_the_first_rule_within_tolerance(spark):
    rules = spark.createDataFrame([(2, "late", "Body", 9.1, 0, None, False), (1, "early", "Body", 9.15, 0, 3, False)], L.RULES)
    got = L.with_roles(S.spans(pages(spark, ([span("x", 1, 1), span("y", 1, 1, s=9.4)], []))), rules, L.Layout()).collect()
    assert sorted((r.t, r.role, r.level) for r in got if r.role) == [("x", "early", 3)] and len(got) == 2


def cell(t, x, y, role="cell", w=20):
    return {"t": t, "x": float(x), "x1": float(x + w), "y": float(y), "role": role}


def grid(spark, spans):
    rows = [(1, "table0", i, s["t"], s["x"], s["y"], [s["x"], 0.0, s["x1"], 0.0], s["role"]) for i, s in enumerate(spans)]
    got = T.grids(spark.createDataFrame(rows, "page int, region string, pos int, t string, x double, y double, bbox array<double>, role string")).first()
    return {"header": got.header, "rows": got.rows}


def test_wrapped_cells_and_trimodal_gaps(spark):
    spans = [cell("Name", 10, 0, "table.header"), cell("Effect", 60, 0, "table.header")]
    for i, y in enumerate((20, 47, 74)):
        spans += [cell(f"n{i}", 10, y), cell("first", 60, y), cell("second", 60, y + 12)]
    assert grid(spark, spans) == {"header": ["Name", "Effect"], "rows": [[f"n{i}", "first second"] for i in range(3)]}


def test_key_value_by_role_and_soft_hyphen(spark):
    spans = [cell("Key", 10, 0, "table.header"), cell("one ha­", 40, 0), cell("lf", 40, 10), cell("Other", 10, 22, "table.header"), cell("two", 40, 22)]
    assert grid(spark, spans) == {"header": [], "rows": [["Key", "one half"], ["Other", "two"]]}


def test_wide_cell_does_not_bridge_columns(spark):
    spans = [cell("A", 10, 0, "table.header"), cell("B", 60, 0, "table.header"), cell("wide", 10, 20, w=70), cell("x", 10, 40), cell("y", 60, 40)]
    got = grid(spark, spans)
    assert got["header"] == ["A", "B"] and got["rows"][1] == ["x", "y"]


@pytest.mark.parametrize("ys,want", [([], 0.0), ([1, 2.2, 3.4], 0.2), ([0, 12, 27, 39, 54], 13.5), ([0, 0.3], 0.0)])
def test_row_threshold(spark, ys, want):
    gaps = spark.createDataFrame([([float(b - a) for a, b in zip(ys, ys[1:], strict=False)],)], "gaps array<double>")
    assert abs(gaps.select(split_threshold(F.col("gaps")).alias("x")).first().x - want) < 1e-9


def test_grids_and_side_panels(spark):
    rects = [rect(50, 200, 150, 260, 0.9), rect(157, 200, 260, 260, 0.9)]
    spans = [span("H", 55, 190, f="Bold", w=20), span("H", 160, 190, f="Bold", w=20), span("a", 55, 215, f="Cell", w=8), span("b", 160, 215, f="Cell", w=8)]
    p = pages(spark, (spans, rects))
    layout = L.Layout()
    at = L.placed(L.with_roles(S.spans(p), spark.createDataFrame(RULES, L.RULES), layout), L.regions(S.rects(p), layout), layout)
    found = T.grids(at).withColumn("caption", F.lit(None).cast("string")).withColumn("no", F.substring("region", 6, 9).cast("int"))
    assert [(r.header, r.rows) for r in T.side_panels(found, ["page"], ["no"]).collect()] == [(["H"], [["a"], ["b"]])]


def test_side_panels_go_on_without_caption(spark):
    rows = [(0, 1, "Cap", ["A", "B"], [["1", "2"]]), (1, 1, None, ["A", "B"], [["3", "4"]]), (2, 1, None, ["A|B"], [["5"]]), (3, 1, "New", ["A|B"], [["6"]]), (4, 2, None, ["A|B"], [["7"]]), (9, 2, None, [], [["8"]]), (10, 2, None, [], [["9"]])]
    got = T.side_panels(spark.createDataFrame(rows, "seq int, page int, caption string, header array<string>, rows array<array<string>>").withColumn("doc", F.lit("d")), ["doc"], ["seq"])
    assert [(r.seq, r.caption, [x[0] for x in r.rows]) for r in got.orderBy("seq").collect()] == [(0, "Cap", ["1", "3"]), (2, None, ["5"]), (3, "New", ["6"]), (4, None, ["7"]), (9, None, ["8"]), (10, None, ["9"])]


def test_page_source_and_round_trip(spark, tmp_path):
    p = pages(spark, ([span("hi", 1, 2)], [rect(0, 0, 50, 50, 0.9)]))
    S.write_pages(p, f"{tmp_path}/p")
    assert S.read_pages(spark, f"{tmp_path}/p").collect() == p.collect()
    spark.dataSource.register(S.PageSource)
    files = ",".join(str(x) for x in (tmp_path / "p").glob("part*.json") if x.stat().st_size)
    assert [r.spans[0].t for r in spark.read.format("quire_pages").option("path", files).load().collect()] == ["hi"]
    assert S.fingerprint(spark, f"{tmp_path}/p/part*").count() >= 1
    inv = S.inventory(S.spans(p))
    assert inv.first().n == 1 and S.unknown(inv, spark.createDataFrame(RULES, L.RULES)).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_are_placed_without_being_sorted_by_all_they_have(spark):
    at = spark.createDataFrame([(1, i, 60.0 * i, 50.0, "cell", False) for i in range(5)], "page int, pos int, x double, y double, role string, discard boolean")
    found = spark.createDataFrame([(1, "table", 0, 40.0, 40.0, 100.0, 60.0), (1, "table", 1, 50.0, 40.0, 130.0, 60.0), (1, "sidebar", 0, 170.0, 0.0, 200.0, 90.0)], "page int, kind string, idx int, x0 double, y0 double, x1 double, y1 double")
    got = L.placed(at, found, L.Layout())
    assert "SortAggregate" not in plan(got) and [r.region for r in got.orderBy("pos").collect()] == [None, "table0", "table1", "sidebar0", None]


def test_pages_are_dealt_once_for_reading_order(spark):
    rows = [(1, "a", 0, 10.0), (1, "wide", -1, 10.0), (1, "on", -1, 40.0), (1, "beside", 0, 30.0), (1, "level", 1, 40.0), (1, "far", -1, 90.0), (1, "between", 0, 60.0), (1, "after", 0, 91.0), (2, "alone", 1, 5.0)]
    got = L.reading_order(spark.createDataFrame(rows, "page int, t string, column int, y double").withColumn("x0", F.lit(1.0)), L.Layout())
    assert plan(got).count("Exchange") == 1
    assert [r.t for r in got.orderBy("page", "seq").collect()] == ["a", "beside", "level", "wide", "on", "between", "far", "after", "alone"]


def test_regions_are_gathered_once_for_grids(spark):
    rows = [(1, "table0", 0, "H", 10.0, 0.0, "table.header"), (1, "table0", 1, "a", 10.0, 20.0, "cell"), (1, "table1", 2, "K", 10.0, 20.0, "table.header"), (1, "table1", 3, "v", 60.0, 20.0, "cell"), (2, "table0", 4, "only", 10.0, 5.0, "table.header"), (2, "sidebar0", 5, "none", 10.0, 5.0, "cell")]
    got = T.grids(spark.createDataFrame(rows, "page int, region string, pos int, t string, x double, y double, role string").withColumn("bbox", F.lit(None).cast("array<double>")))
    assert plan(got).count("Exchange") == 1 and "Join" not in plan(got)
    assert [(r.header, r.rows) for r in got.orderBy("page", "region").collect()] == [(["H"], [["a"]]), ([], [["K", "v"]]), (["only"], [])]
