"""SimHash links and components against all pairs."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash
from quire.llm.graph import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(points, most=3):
    root = {x: x for x in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in points:
        for b in points:
            if a < b and (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in points}


def texts(seed=1):
    pick = random.Random(seed)
    word = lambda: pick.choice("alpha beta gamma delta É épsilon zeta eta".split()) + str(pick.randrange(40))
    base = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 40, 300, 900)]
    near = []
    for _ in range(60):
        w = base[4].split()
        for _ in range(pick.randrange(4)):
            w[pick.randrange(len(w))] = word()
        near.append(" ".join(w))
    return [*base, *near, *near[:3], "ONE two", "one TWO", "", None, None, "  \n", "A b c d"]


def test_near_duplicates_are_all_pairs(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "one two", "y"), (3, texts()[3], None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    of = {(i, t): plain_fingerprint(t) for i, t, _ in rows}
    roots = plain_components(sorted(set(of.values())))
    least = {}
    for (i, _), f in of.items():
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    want = sorted(repr((i, of[i, t], least[roots[of[i, t]]])) for i, t, _ in rows)
    assert sorted(repr((r.doc_id, r.fp % (1 << 64), r.component_id)) for r in got) == want


def linked(spark, points, limit):
    frame = spark.createDataFrame([(int(p) - (1 << 64) if int(p) >> 63 else int(p),) for p in points], "fp long")
    found = components(simhash.links(frame, limit=limit)).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node % (1 << 64))
    return sorted(map(sorted, groups.values()))


def test_links_of_random_and_crowded_points(spark):
    pick = random.Random(7)
    centre = [pick.getrandbits(64) for _ in range(8)]
    points = set(centre) | {pick.getrandbits(64) for _ in range(300)}
    for c in centre[:3]:
        for _ in range(150):
            x = c
            for _ in range(pick.randrange(1, 5)):
                x ^= 1 << pick.randrange(64)
            points.add(x)
    want = {}
    for x, r in plain_components(sorted(points)).items():
        want.setdefault(r, []).append(x)
    want = sorted(sorted(v) for v in want.values() if len(v) > 1)
    assert linked(spark, points, simhash.CELL) == want
    assert linked(spark, points, 5) == want  # crowded cells go the second way


def test_embedding_bounds_distance(spark):
    pick = np.random.default_rng(3)
    x, y = pick.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2) + np.uint64(1), pick.integers(0, 2**63, 200).astype(np.uint64)
    count = lambda v: np.array([[(int(a) >> 2 * k & 3).bit_count() for k in range(32)] for a in v])
    manhattan = np.abs(count(x) - count(y)).sum(1)
    assert (np.bitwise_count(simhash._unary(x) ^ simhash._unary(y)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(x ^ y)).all()
    rows = spark.createDataFrame([(int(v.view(np.int64)),) for v in x], "fp long").select(simhash.embed(F.col("fp")).alias("t")).collect()
    assert [r.t % (1 << 64) for r in rows] == simhash._unary(x).tolist()


def test_keep_one_and_empty(spark):
    rows = [(5, "a b c d", "p"), (2, "A b c d", "q"), (2, "A b c d", "q"), (9, "other text altogether here", "r"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 9), (True, 0)]
    assert simhash.report(docs.limit(0)).count() == 0


def test_chain_components(spark):
    n = 70
    links = [(i, i + 1) for i in range(n)] + [(500 + i, 500) for i in range(1, 40)] + [(7, 7)]
    links = spark.createDataFrame(links, "a long, b long")
    for block in (1 << 20, 20):  # in one task, and in rounds
        got = {r.node: r.root for r in components(links, block=block).collect()}
        assert got == {**{i: 0 for i in range(n + 1)}, **{500 + i: 500 for i in range(40)}}
    assert components(links.limit(0)).count() == 0
