"""Every operator that filters or changes documents: clashing names, nulls, repeats, ties, long texts, empty tables."""

import random

import pytest

from quire.llm import decontam, langid, mixing, quality, rules, secrets, simhash, toxicity
from tests.llm.test_langid import SAMPLES

ITEM = "one two three four five six seven eight nine ten eleven twelve"
CLASHING = "__lang __id __sig __hits __digest __got __quality __toxic __secrets __mark __markn __copies __copiesn copy_no g l s h m n i t fp sig cell part size target copies component_id A.b"


def documents(spark):
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice(SAMPLES[list(SAMPLES)[i % 3]].split()) for _ in range(60)), list(SAMPLES)[i % 3], f"s{i % 3}") for i in range(60)]
    rows += rows[:5] * 3 + [rows[7]] * 300  # repeats, one of them very often
    rows += [(None, rows[0][1], "en", None), (None, None, None, None), (70, "", None, "s1"), (71, None, "en", "s0"), (72, "word " * 150_000, "en", "s1"), (73, rows[2][1] + " " + ITEM, None, "s2"), (74, "x password=12345678 y", "en", "s0")]
    rows += [(80, rows[9][1], "en", "p"), (80, rows[9][1], "en", "q")]  # one id and text, two sources
    frame = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    odd = [f"cast(coalesce(doc_id, -1) % 7 as {('string', 'int', 'double')[k % 3]}) as `{c}`" for k, c in enumerate(CLASHING.split())]
    return frame.selectExpr("*", *odd, "map('k', doc_id) as __map", "array(text) as __list")


def bench(spark):
    return spark.createDataFrame([(i, ITEM if i == 1 else f"item {i} with other words " + "z y x " * i) for i in range(12)], "item_id long, text string")


STAGES = {
    "langid": lambda spark, docs: langid.keep_known(docs),
    "simhash": lambda spark, docs: simhash.keep_one(docs),
    "decontam": lambda spark, docs: decontam.decontaminate(docs, bench(spark), count_col="n_chars"),
    "decontam_blocks": lambda spark, docs: decontam.decontaminate(docs, bench(spark), count_col="n_chars"),
    "secrets": lambda spark, docs: secrets.redacted(docs, count_col="n_chars"),
    "mixing": lambda spark, docs: mixing.mix(docs),
    "rules": lambda spark, docs: rules.keep_good(docs),
    "quality": lambda spark, docs: quality.keep_good(docs, quality.Constant(0.9)),
    "toxicity": lambda spark, docs: toxicity.keep_civil(docs, toxicity.fit([b"ugly stuff here"] * 3, [b"fine"])),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_on_odd_documents(spark, tmp_path, monkeypatch, name):
    if name == "decontam_blocks":
        monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    want = [*docs.columns, "copy_no_"] if name == "mixing" else docs.columns
    results = []
    for k, n in enumerate((1, 3)):
        out = STAGES[name](spark, docs.repartition(n))
        assert out.columns == want
        out.write.parquet(f"{tmp_path}/out{k}")
        rows = spark.read.parquet(f"{tmp_path}/out{k}").collect()
        results.append(sorted(map(repr, rows)))
    assert results[0] == results[1]  # whatever the partitions
    seen = {(r.doc_id, r.text) for r in docs.collect()}
    if name not in ("decontam", "decontam_blocks", "secrets"):
        assert {(r.doc_id, r.text) for r in rows} <= seen
    ids = [r.doc_id for r in rows]
    if name == "simhash":
        assert ids.count(7) == 1 and 72 in ids and len(set(ids)) == len(ids)
    if name.startswith("decontam"):
        assert len(rows) == docs.count() and ITEM not in " ".join(r.text or "" for r in rows if r.doc_id == 73)
    if name == "secrets":
        assert len(rows) == docs.count() and [r.text for r in rows if r.doc_id == 74] == ["x [secret] y"]
    if name in ("quality", "toxicity"):
        assert len(rows) == docs.count()
    if name == "langid":
        assert set(ids) >= set(range(60)) and 70 not in ids and 71 not in ids
    empty = STAGES[name](spark, docs.limit(0))
    assert empty.columns == want and empty.count() == 0


def test_both_ways_of_decontamination_agree(spark, monkeypatch):
    docs = documents(spark).select("doc_id", "text")
    one = sorted(map(repr, decontam.report(docs, bench(spark)).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    assert sorted(map(repr, decontam.report(docs, bench(spark)).collect())) == one


def test_copies_of_one_document(spark):
    """A document that is there very often gets its copies like as many documents would."""
    rows = [(1, "a b c d", "s", k) for k in range(500)] + [(i, f"x{i} y z w", "s", 0) for i in range(2, 400)] + [(900 + i, "w " * 9, "t", 0) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, k long")
    told = [sorted(map(repr, mixing.report(frame.repartition(n)).collect())) for n in (2, 5)]
    assert told[0] == told[1]
    got = mixing.report(frame).collect()
    assert len(got) == len(rows)
    for source, size in (("s", 4), ("t", 9)):
        own = [r for r in got if r.size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(9, 0.01 * own[0].target), source
    assert {r.copies for r in got if r.doc_id == 1} <= {0, 1, 2, 3}
