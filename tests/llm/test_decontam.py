"""The suffix automaton against a plain search for every window."""

import random
import re

import pytest

from quire.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_hit string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, window):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(own) - k + 1):
                if own[j : j + k] == w[i : i + k]:
                    hit.update(range(j, j + k))
                    found.add(str(name) if name is not None else "null")
    return len(own), len(hit), len(found), decontam.items_digest(list(found)), bool(hit)


def made(seed):
    pick = random.Random(seed)
    text = lambda n: " ".join(pick.choice(["a", "b", "c", "É1"]) for _ in range(n))
    items = [(i, text(pick.choice([0, 1, 3, 5, 9, 14]))) for i in range(6)] + [(None, "zz yy"), (7, None), (7, ""), (0, "b")]
    docs = [(i, text(pick.choice([0, 2, 30, 200])) + ("\x01 zz;YY." if i % 3 == 0 else ""), "x") for i in range(12)] + [(None, "a a a a a", None), (3, None, None), (3, "", "x"), (4, "b " * 5000, "x")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("window", [1, 4, 10])
def test_report_is_plain_search(spark, seed, window):
    docs, items = made(seed)
    got = decontam.report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
    key = lambda x: repr(tuple(x))
    assert sorted(map(key, got)) == sorted(key((d, *plain(t, items, window))) for d, t, _ in docs)


def test_blocks_of_items_agree(spark, monkeypatch):
    docs, items = made(4)
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.report(*frames, window=4).collect()
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 12)
    assert sorted(map(repr, decontam.report(*frames, window=4).collect())) == sorted(map(repr, whole))


def test_removal(spark):
    docs = [(1, "Keep this. One two, three FOUR five! And this too.", 9), (2, "one two three four five six", 1), (3, None, None), (4, "clean", 5)]
    items = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    out = {r.doc_id: r for r in decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string, n_chars long"), items, window=5, count_col="n_chars").collect()}
    assert sorted(out) == [1, 3, 4]
    assert out[1].text == "Keep this. ! And this too." and out[1].n_chars == len(out[1].text)
    assert out[4].n_chars == 5


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(docs, items).count() == 0
    assert decontam.report(spark.createDataFrame([(1, "a b", "x")], DOCS), items).first()[1:3] == (2, 0)
