"""Targets against plain water-filling, multipliers against bisection, copies against their bounds."""

import math
import random
from collections import Counter, defaultdict

from quire.llm import mixing

SCHEMA = "doc_id long, text string, source string, target double, n long"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, stopped, left = {}, set(), sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            stopped.add(s)


def docs(seed):
    pick = random.Random(seed)
    out = []
    for i in range(400):
        source = pick.choice(["a", "a", "a", "b", "B", "é", "z", None])
        n = pick.choice([0, 1, 3, 7, 20, 20, 20, 80])
        out.append((i, " \t".join(["w"] * n) if n else pick.choice(["", None, " \n"]), source, -1.0, 5))
    out += [(i, "x " * 30, "hot", None, None) for i in range(400, 700)]
    out += [(1000, "y " * 6000, "a", None, None), (1001, None, "empty", None, None), (None, "q r s", "b", None, None), (7, "same same", "b", None, None), (7, "same same", "b", None, None)]
    return out


def test_targets_rates_and_copies(spark):
    rows = docs(1)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = mixing.report(frame).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s, _, _ in rows:
        size[s] += len((t or "").split())
    want = plain_targets(size)
    own = defaultdict(int)
    texts = defaultdict(list)
    for i, t, s, _, _ in rows:
        texts[i].append((s, len((t or "").split())))
    by_size = Counter((r.doc_id, r.size) for r in got)
    assert by_size == Counter((i, n) for i, v in texts.items() for _, n in v)
    source_of = {size[s]: s for s in size}
    for r in got:
        s = source_of[r.source_size]
        assert math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size
        own[s] += r.taken
    for s, t in want.items():
        assert abs(own[s] - t) <= max(3, 0.005 * t), (s, own[s], t)
    again = mixing.report(frame.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_multipliers_solve_the_dual(spark):
    cells = [("+a", 1, 50), ("+a", 10, 20), ("+a", 400, 2), ("+b", 5, 10), ("+b", 6, 10)]
    wanted = [("+a", 1050, 72, 500.0), ("+b", 110, 20, 200.0)]
    got = {r.s: r.l for r in mixing.multipliers(spark.createDataFrame(cells, "s string, size long, n long"), spark.createDataFrame(wanted, "s string, source_size long, n_docs long, target double")).collect()}
    for s, total, n_docs, target in wanted:
        f = lambda k: sum(n * z * min(3.0, math.exp(k * z * n_docs / total)) for c, z, n in cells if c == s)  # noqa: E731, B023
        lo, hi = -100.0, 100.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if f(mid) < target else (lo, mid)
        assert math.isclose(got[s], lo, rel_tol=1e-5, abs_tol=1e-6)


def test_mix_repeats_documents(spark):
    rows = docs(2)
    frame = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(frame)
    assert out.columns == [*frame.columns, "copy_no"]
    taken = {(r.doc_id, r.size): r.copies for r in mixing.report(frame).collect() if r.doc_id not in (7, None)}
    seen = Counter((r.doc_id, len((r.text or "").split())) for r in out.collect() if r.doc_id not in (7, None))
    assert seen == Counter({k: v for k, v in taken.items() if v})


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.report(empty).count() == 0 and mixing.mix(empty).count() == 0
    nothing = mixing.report(spark.createDataFrame([(1, None, None, 0.0, 0)], SCHEMA)).first()
    assert (nothing.size, nothing.target, nothing.taken) == (0, 0.0, 0)
