"""The convolutional network and the toxicity lexicon: exactness against plain code, held-out accuracy, edges."""

import random
import re

import numpy as np

from quire.llm import quality, toxicity

DOCS = "doc_id long, text string, lang string, score double"
LABELS = "doc_id long, quality int, toxic int, text string"


def plain_features(net, text):
    data = (text or b"\0") + b"\0" * (quality.WIDTH - 1)
    n = len(data) - quality.WIDTH + 1
    z = np.array([sum(net.table[k][data[i + k]] for k in range(quality.WIDTH)) for i in range(n)])
    blocks = [z[i : i + quality.HALF].max(0) for i in range(0, n, quality.HALF)]
    chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
    live = np.maximum(np.array(chunks) + net.bias, 0)
    return np.concatenate([live.mean(0), live.max(0)])


def test_network_covers_whole_texts():
    net, pick = quality.Network(3), random.Random(1)
    net.bias += 0.1
    texts = [None, b"", b"x", bytes(pick.randrange(256) for _ in range(127)), b"ab" * 64, b"abc" * 43, bytes(pick.randrange(256) for _ in range(5000)), b"z" * 200_000 + b"end"]
    got = net.features(texts)
    for t, row in zip(texts[:-1], got, strict=False):
        assert np.allclose(plain_features(net, t), row, atol=1e-4)
    assert not np.allclose(net.features([b"z" * 200_000])[0], got[-1])
    assert np.allclose(net.score(texts), [net.score([t])[0] for t in texts], atol=1e-6)


def test_gradients_are_right():
    net, pick = quality.Network(2), np.random.default_rng(1)
    data = pick.integers(1, 256, (5, quality.CHUNK + quality.WIDTH - 1)).astype(np.uint8)
    n, y, share = np.array([2, 3]), np.array([1.0, 0.0]), np.array([1.0, 1.0])
    places = np.array([256, 200, 256, 256, 3])
    g = net._gradients(data, places, n, y, share)

    def loss():
        total, at = 0.0, 0
        for size, label in zip(n, y, strict=True):
            z = [sum(net.table[k][c[k : k + quality.CHUNK]] for k in range(quality.WIDTH))[:m].max(0) + net.bias for c, m in zip(data[at : at + size], places[at : at + size], strict=True)]
            live = np.maximum(np.array(z), 0)
            p = 1 / (1 + np.exp(-(np.concatenate([live.mean(0), live.max(0)]) @ net.out + net.offset)))
            total -= np.log(p if label else 1 - p) / len(n)
            at += size
        return float(total)

    for name, at in (("out", (3,)), ("bias", (2,)), ("table", np.unravel_index(np.abs(g["table"]).argmax(), g["table"].shape))):
        value, eps = getattr(net, name), 1e-2
        value = value.astype(np.float64)
        setattr(net, name, value)
        value[at] += eps
        up = loss()
        value[at] -= 2 * eps
        down = loss()
        value[at] += eps
        assert abs((up - down) / (2 * eps) - g[name][at]) < 5e-3


def corpus(seed=1, n=400):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefghilmnorstu") for _ in range(pick.randrange(2, 9)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(pick.randrange(60, 300))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            words = pick.choice([[w.upper() + "!!" for w in words], [words[0]] * len(words), [w + "%%%" for w in words]])
        if toxic:
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(["grobian", "lumpen", "schuft", "wicht"]))
        docs.append((i, " ".join(words), "de", None))
        labels.append((i, int(not bad), int(toxic), "x"))
    odd = [(None, "text without id", None, None), (n + 1, None, None, None), (n + 2, "", None, None), (n + 3, "long " * 60_000, None, 1.0), (3, docs[3][1], "de", None)]
    return docs + odd, labels + [(None, 1, 1, ""), (5, 1, None, ""), (n + 1, 1, 0, ""), (n + 9, None, None, None)]


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, lb = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    truth = {r[0]: r for r in labels[:400]}
    for got, column in ((quality.report(d, lb).collect(), 1), (toxicity.report(d, lb).collect(), 2)):
        assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
        held = [r.predicted == truth[r.doc_id][column] for r in got if r.held_out and r.doc_id in truth]
        assert len(held) > 50 and np.mean(held) >= 0.93
    assert quality.keep_good(d, quality.Constant(0.2)).count() == 0 and quality.keep_good(d, quality.Constant(0.9)).columns == d.columns


def test_nothing_to_learn(spark):
    d = spark.createDataFrame([(1, "a", None, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert toxicity.report(d, none).first()["score"] == 0 and quality.report(d, none).first()["score"] == 0.5
    assert quality.report(d.limit(0), none).count() == 0 and toxicity.report(d.limit(0), none).count() == 0


def plain_found(lex, folded):
    total = 0.0
    spared = [(m.start() + 1, m.end()) for e in lex.exceptions for m in re.finditer(f"(?= {re.escape(e.strip())} )", folded) for m in [re.compile(re.escape(e.strip())).search(folded, m.start())]]
    for m in re.finditer(r"[^ ]+", folded):
        w = lex.weights.get(m[0])
        if w and not any(a - 1 <= m.start() and m.end() <= b for a, b in spared):
            total += w
    return total


def test_lexicon_folding_and_exceptions():
    lex = toxicity.Lexicon({toxicity.fold(w.encode()).strip(): 2.0 for w in ("idiot", "trash", "clown", "scum", "loser")})
    f = lambda s: lex.found(toxicity.fold(s.encode()))
    assert f("1d10t") == f("ІDІОТ") == f("íd​iot") == f("ｉｄｉｏｔ") == f("IDIOT!!") == f("l0$er") == 2.0
    assert f("idiotic") == f("nidiot") == f("") == 0
    assert f("trash can") == 0 and f("trash canister") == 2.0 and f("trash trash can clown fish clown") == 4.0
    for s in ("trash can idiot", "clown clown fish", "a scum b", "soap scum scum"):
        assert f(s) == plain_found(lex, toxicity.fold(s.encode()))
    lex.curve = (-3.0, 2.0)
    assert lex.score(b"idiot") > lex.score(b"idiot " + b"word " * 3000) > lex.score(b"word " * 3000)


def test_features_do_not_depend_on_the_batch():
    pick = random.Random(4)
    texts = [bytes(pick.randrange(32, 127) for _ in range(pick.randrange(1, 12))) for _ in range(600)]
    net = quality.Network()
    alone = np.concatenate([net.features([t]) for t in texts])
    assert np.allclose(net.features(texts), alone, atol=1e-5)


def test_training_sees_what_scoring_sees():
    net, pick = quality.Network(3), random.Random(6)
    net.bias += 0.1
    for n in (0, 1, 2, 5, 20, 127, 128, 129, 200, 256, 257, 300, 384, 385, 1000, 5000):
        text = bytes(pick.randrange(1, 256) for _ in range(n))
        data, places = quality._chunks(text)
        live = np.maximum(net._pooled(data, places)[1], 0)
        assert np.allclose(np.concatenate([live.mean(0), live.max(0)]), net.features([text])[0], atol=1e-4), n


def test_repeated_ids_are_learned_from_once(spark):
    docs, labels = corpus()
    d, lb = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    again = d.unionByName(d.filter("doc_id % 3 = 0")).unionByName(d.filter("doc_id % 3 = 0"))
    assert toxicity.learn(again, lb.unionByName(lb)).weights == toxicity.learn(d, lb).weights
    one, two = quality.learn(d, lb), quality.learn(again, lb.unionByName(lb))
    assert np.array_equal(one.table, two.table)
