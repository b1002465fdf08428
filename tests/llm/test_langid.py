"""Context trees against a plain computation of code lengths, and held-out accuracy."""

import math
import random
from collections import Counter

from quire.llm import langid


def plain_bits(train, text, order, contexts, symbols):
    """PPM, method C with exclusion, over contexts that both have counts and are kept."""
    counts = {}
    stream = langid.BREAK + langid.BREAK.join(train)
    for k in range(order + 1):
        for i in range(len(stream) - k):
            counts.setdefault(stream[i : i + k], Counter())[stream[i + k]] += 1
    total = 0.0
    full = langid.BREAK + text
    for i in range(len(langid.BREAK), len(full)):
        ctx = full[i - order : i]
        while ctx not in contexts:
            ctx = ctx[1:]
        total -= math.log2(prob(counts, ctx, full[i], symbols))
    return total


def prob(counts, ctx, s, symbols):
    c = counts.get(ctx, Counter())
    lower = (lambda t: 1 / symbols) if not ctx else (lambda t: prob(counts, ctx[1:], t, symbols))
    if not c:
        return lower(s)
    n, q = sum(c.values()), len(c)
    if s in c:
        return c[s] / (n + q)
    rest = 1 - sum(lower(t) for t in c)
    return q / (n + q) * lower(s) / rest


def test_code_lengths_are_plain_ppm():
    pick = random.Random(5)
    train = {lang: ["".join(pick.choice(abc) for _ in range(40)).encode() for _ in range(3)] for lang, abc in (("x", "abc "), ("y", "acé "))}
    trees = langid.Trees(train)
    folded = {lang: [langid.folded(t) for t in own] for lang, own in train.items()}
    streams = [langid.BREAK + langid.BREAK.join(own) for own in folded.values()]
    contexts = {b""}
    for k in range(1, 4):
        seen = Counter(s[i : i + k] for s in streams for i in range(len(s) - k + 1))
        contexts |= {c for c, n in seen.items() if n >= 2 and c[1:] in contexts}
    for text in (b"abcab acc", "caéé".encode(), b"a", b"cc cc"):
        got = trees.lengths([b"aa", text, text])
        for col, lang in enumerate(trees.names):
            want = plain_bits(folded[lang], text, 3, contexts, trees.width)
            assert abs(got[1, col] - want) < 1e-3 * max(1, want) and got[1, col] == got[2, col]


SAMPLES = {"en": "the of and with this that from which", "de": "der die und mit nicht eine für über", "es": "que los con una para más año niño"}


def rows(n=240):
    pick = random.Random(3)
    out = []
    for i in range(n):
        lang = pick.choice(list(SAMPLES))
        out.append((i, " ".join(pick.choice(SAMPLES[lang].split()) for _ in range(pick.randrange(3, 40))), lang, "s", -1.0))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, score double"


def test_held_out_accuracy_and_edges(spark):
    odd = [(1000, None, "en", None, None), (1001, "", "de", None, None), (1002, "12 -- !!", None, None, None), (1003, "the and " * 50000, None, None, None), (None, "und der die", None, None, None), (1004, "日本", None, None, None)]
    data = rows()
    docs = spark.createDataFrame(data + odd, SCHEMA)
    got = {r.doc_id: r for r in langid.report(docs).collect()}
    held = [(lang, got[i].lang_pred) for i, _, lang, _, _ in data if got[i].held_out]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000].score == 0
    assert got[1003].lang_pred == "en" and got[None].lang_pred == "de" and got[1004].lang_pred in SAMPLES
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(data) + 3


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "the and", None, None, None)], SCHEMA)
    assert langid.report(docs).first().lang_pred == "und"
    assert langid.report(docs.limit(0)).count() == 0
