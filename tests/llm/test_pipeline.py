"""The pipeline's stages, each on its own input, and the whole against them."""

import random
import zlib

import corpus_pipeline
from quire.llm import decontam
from tests.llm.test_decontam import plain as plain_contamination
from tests.llm.test_langid import SAMPLES
from tests.llm.test_simhash import plain_components, plain_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "one two three four five six seven eight nine ten eleven twelve"


def corpus(folder, spark):
    pick = random.Random(9)
    rows = []
    for i in range(150):
        lang = list(SAMPLES)[i % 3]
        rows.append((i, " ".join(pick.choice(SAMPLES[lang].split()) + pick.choice(["", "x", "y"]) for _ in range(pick.randrange(30, 90))), lang, f"s{i % 4}"))
    rows += [(200, rows[3][1], "de", "s1"), (201, None, None, None), (202, "123 456", None, "s2"), (203, rows[5][1] + " " + ITEM, "es", None), (204, ITEM, "en", "s0"), (205, rows[7][1] + " password=abcdefgh123", "en", "s3")]
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], SCHEMA)
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return {r[0]: r for r in rows}


def test_stages_and_run(spark, tmp_path):
    rows = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "mix"]
    ids = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "mix":
            assert out.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/out/{k}")
        docs = spark.read.parquet(f"{tmp_path}/out/{k}")
        ids[name] = {r.doc_id: r for r in docs.collect()}
    assert set(rows) - set(ids["language"]) == {201, 202}
    left = {i: plain_fingerprint(rows[i][1]) for i in ids["language"]}
    roots = plain_components(sorted(set(left.values())))
    first = {}
    for i, f in sorted(left.items()):
        first.setdefault(roots[f], i)
    assert set(ids["near_duplicates"]) == set(first.values()) and 200 not in first.values()
    for i in ids["near_duplicates"]:
        n, hit, *_ = plain_contamination(rows[i][1], [(1, ITEM)], 10)
        assert (i in ids["decontaminate"]) == (hit <= 0.5 * n)
        if i in ids["decontaminate"]:
            assert plain_contamination(ids["decontaminate"][i].text, [(1, ITEM)], 10)[1] == 0
            assert (ids["decontaminate"][i].text == rows[i][1]) == (hit == 0)
    assert set(ids["secrets"]) == set(ids["decontaminate"])
    if 205 in ids["secrets"]:
        assert "abcdefgh123" not in ids["secrets"][205].text and ids["secrets"][205].n_chars == len(ids["secrets"][205].text)
    got = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (r.doc_id, r.copy_no, zlib.crc32((r.text or "").encode()))
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect()))
    assert docs.groupBy("doc_id").count().selectExpr("max(count)").first()[0] <= 3


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert decontam.WORD_BYTES[0x41] == 0x20
