"""Measures against plain counting, fences against plain quartiles."""

import random
import re

import pytest

from quire.llm import rules

SCHEMA = "doc_id long, text string, lang string, source string, kept string"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 3)}
    lines, dup, old = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in old
            old.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def texts():
    pick = random.Random(4)
    word = lambda: pick.choice(["a", "bb", "é", "日本", "x#", "$$"]) + pick.choice(["", "1", "2", "3"])
    out = [None, "", " ", "\n\n", "one", "one two", "a b c", "a b c a b c", "x x x x x", "l\nl\nl\r\n \nl", " lead\ttrail \x0b", " a b c", "w " * 3000]
    for n in (5, 30, 200):
        out += [pick.choice([" ", "\n", "  "]).join(word() for _ in range(n)) for _ in range(6)]
    return out


def test_measures_are_plain_counts(spark):
    rows = [(i, t, "en", "s", "no") for i, t in enumerate(texts())]
    got = {r.doc_id: tuple(r)[1:6] for r in rules.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t, *_ in rows:
        assert got[i] == plain(t), repr(t)[:60]


@pytest.mark.parametrize("v,want", [(0, 0), (5, 5), (255, 255), (256, 256), (257, 256), (1000, 1000), (1001, 1000), (123456, 123392)])
def test_sketch_keeps_eight_bits(spark, v, want):
    assert spark.range(1).select(rules.rounded(rules.F.lit(v).cast("bigint")).alias("x")).first().x == want


def good(seed, n=120):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randrange(2, 9))) for _ in range(n))


def test_fences_adapt_and_merge(spark):
    rows = [(i, good(i), "en", "s1", None) for i in range(80)]
    rows += [(100 + i, " ".join(w + "%%%" for w in good(i).split()), "en", "s1", None) for i in range(8)]  # junk among good
    rows += [(200 + i, good(500 + i), None, None, None) for i in range(3)]  # too few for a sketch of their own
    rows += [(300, good(7)[:20], "en", "s1", None), (301, "The " * 100, "en", "s1", None), (302, None, None, "s1", None), (0, good(0), "en", "s1", None)]
    got = [(r.doc_id, r.base_failed, r.kept) for r in rules.report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    kept = {i for i, _, k in got if k}
    assert kept == set(range(80)) | {200, 201, 202}
    assert {i for i, b, _ in got if b} == {300, 301, 302}
    frame = spark.createDataFrame(rows, SCHEMA)
    again = rules.keep_good(frame)
    assert again.columns == frame.columns and {r.doc_id for r in again.collect()} == kept


def test_fences_differ_between_groups(spark):
    """A rate of symbols that is common in one source is far out in another; so with word lengths in two languages."""
    some = lambda seed, every: " ".join(w + ("#" if i % every == 0 else "") for i, w in enumerate(good(seed).split()))
    rows = [(i, some(i, 4 + i % 5), "en", "code", None) for i in range(150)] + [(1000 + i, good(2000 + i), "en", "prose", None) for i in range(600)]
    rows += [(2000 + i, " ".join(w * 3 for w in good(3000 + i).split()), "fi", "prose", None) for i in range(150)]
    rows += [(9000, some(9000, 5), "en", "code", None), (9001, some(9000, 5), "en", "prose", None)]
    rows += [(9002, " ".join(w * 3 for w in good(9002).split()), "fi", "prose", None), (9003, " ".join(w * 3 for w in good(9002).split()), "en", "prose", None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    measured = rules.measured(frame, keep=["doc_id", "lang", "source"])
    kept = {r.doc_id for r in rules.judged(measured).filter("kept").collect()}
    assert 9000 in kept and 9001 not in kept and 9002 in kept and 9003 not in kept
    sketch = rules.sketches(measured.selectExpr("*", "lang AS l", "concat(lang, source) AS g"), ["l", "g"])
    found = {r.g: r for r in rules.fences(sketch).collect()}
    assert found["encode"].symbols_high > 3 * found["enprose"].symbols_high
    assert found["fiprose"].length_low > found["enprose"].length_high


def test_small_groups_are_drawn_to_their_language(spark):
    sketch = spark.createDataFrame([("en", "a", "symbols", v, 100) for v in (0, 8, 16, 24)] + [("en", "b", "symbols", 200, 4)], "l string, g string, measure string, v long, n long")
    own = {r.g: (r.q1, r.q3) for r in rules.drawn(rules.quartiles(sketch, ["l", "g"]), rules.quartiles(rules.merged(sketch, ["l"]), ["l"]), ["l"]).collect()}
    assert own["a"] == (0, 16) and own["b"] == ((4 * 200 + 50 * 8) // 54, (4 * 200 + 50 * 24) // 54)


def test_repeats_ties_long_texts_and_clashing_names(spark):
    rows = [(i, good(i), "en", "s", "k") for i in range(60)] * 2 + [(70, good(7, 200_000), "en", "s", "k"), (None, good(8), None, "en", None), (None, good(8), "en", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, __mark string").selectExpr("*", "doc_id AS g", "text AS l", "lang AS __n", "map('a', doc_id) AS kept")
    again = rules.keep_good(frame)
    assert again.columns == frame.columns
    got = sorted((r.doc_id is None, r.doc_id, r.lang, r.source) for r in again.collect() if r.doc_id is not None)
    assert len(got) == 121


def test_empty(spark):
    assert rules.report(spark.createDataFrame([], SCHEMA)).count() == 0
