"""Near-duplicates by SimHash, joined on a grid of per-segment bit counts.

A fingerprint's 64 bits form 32 segments of two bits. The counts of set bits, 0 to 2, embed it in a
grid; the Manhattan distance of two embeddings is never more than the Hamming distance of the
fingerprints. With each count in unary (0 = 00, 1 = 01, 2 = 11), it is the popcount of an xor. The
segments form groups; vectors at Manhattan distance k or less are equal on all groups but k, so one
cell for each choice of the groups left out brings every such pair together. Within a cell the
distance bound is tested, then the fingerprints themselves.

Cells give the links of a spanning forest, not all pairs. A cell with over CELL fingerprints isn't
gathered: its members meet again in cells of all but k of 16 four-bit groups of the fingerprint
itself, which hold 4096 different fingerprints at most.

Nulls: a null text has no words, fingerprint zero, and is linked like any other. Equal texts share a
fingerprint; a null doc_id gets a component but never names one (null only if all of its ids are).
Ties: a bit set in exactly half of the shingles is 0; of rows with one id the least hash of the whole
row stays, and of wholly equal rows one. Texts are read whole, however long. Other columns are not
read, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, by_batches, columns_of, cut, fresh, lookup, once_each, row_mark, slices
from quire.llm.graph import components

CELL = 8192
LOW = 0x5555555555555555
SEED = 42


def fingerprint(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of shingle hashes (uint64); starts has each group's first index, no group is empty.

    Eight counters of a byte each are added at once, over 255 hashes at most; those sums are then added up.
    """
    counts = np.diff(np.append(starts, len(hashes)))
    steps = -(-counts // 255)
    first = np.repeat(np.cumsum(steps) - steps, steps)
    cuts = np.repeat(starts, steps) + (np.arange(steps.sum()) - first) * 255
    group = np.cumsum(steps) - steps
    out = np.zeros(len(starts), np.uint64)
    lanes = np.uint64(0x0101010101010101)
    for j in range(8):
        part = np.add.reduceat((hashes >> np.uint64(j)) & lanes, cuts).view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(part, group, axis=0, dtype=np.int64)
        for byte in range(8):
            out |= (2 * total[:, byte] > counts).astype(np.uint64) << np.uint64(8 * byte + j)
    return out


def _fingerprints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for a, b in slices(texts, 2 << 20):
        hashes: list[int] = []
        starts, rows = [], []
        for row in range(a, b):
            words = texts[row].lower().split() if texts[row] else []
            if not words:
                continue
            rows.append(row)
            starts.append(len(hashes))
            if len(words) <= shingle:
                hashes.append(digest(b" ".join(words), SEED))
                continue
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begin = [0, *ends[: -shingle].tolist()]
            hashes += [digest(line[s:e], SEED) for s, e in zip(begin, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
        if rows:
            out[rows] = fingerprint(np.array(hashes, np.uint64), np.array(starts, np.int64))
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sig_col: str | None = None, shingle: int = 3) -> DataFrame:
    """(id_col, sig, fp): sig a 64-bit hash of the text (or sig_col), fp the fingerprint as a signed 64-bit integer."""
    sig = F.xxhash64(text_col) if sig_col is None else F.col(sig_col)
    chosen = docs.select(F.col(id_col).alias("i"), sig.alias("sig"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array(_fingerprints(as_bytes(batch.column(2)), shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], ["i", "sig", "fp"])

    return by_batches(chosen, run, f"i {chosen.schema[0].dataType.simpleString()}, sig bigint, fp bigint").withColumnRenamed("i", id_col)


def embed(fp):
    """32 segment counts in unary."""
    half = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(half).bitwiseAND(F.lit(LOW)).bitwiseOR(F.shiftleft(fp.bitwiseAND(half).bitwiseAND(F.lit(LOW)), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(widths: list[int], left_out: int) -> list[int]:
    """Bit masks of all choices of the groups (of so many bits each), less left_out of them."""
    parts, at = [], 0
    for w in widths:
        parts.append(((1 << w) - 1) << at)
        at += w
    whole = (1 << at) - 1
    return [_signed(whole & ~sum(parts[i] for i in out)) for out in combinations(range(len(parts)), left_out)]


def _forest(x: np.ndarray, t: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among x: breadth first, each round against what is left."""
    links, left = [], np.arange(len(x))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count(t[left] ^ t[u]) <= most  # Manhattan, a lower bound
            near[near] = np.bitwise_count(x[left[near]] ^ x[u]) <= most
            if near.any():
                links += [(u, v) for v in left[near]]
                queue += left[near].tolist()
                left = left[~near]
    return links


def _unary(x: np.ndarray) -> np.ndarray:
    half = x >> np.uint64(1)
    return ((x | half) & np.uint64(LOW)) | ((x & half & np.uint64(LOW)) << np.uint64(1))


def _cells(most: int, limit: int | None):
    """Over rows sorted by cell (k, v): links (a, b); for a cell with more than limit members (a, null) for each."""

    def found(k: np.ndarray, x: np.ndarray, a: list, b: list) -> None:
        edge = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True])))
        size = np.diff(edge)
        two = edge[:-1][size == 2]
        p, q = x[two], x[two + 1]
        near = (np.bitwise_count(_unary(p) ^ _unary(q)) <= most) & (np.bitwise_count(p ^ q) <= most)
        a.append(p[near])
        b.append(q[near])
        for s, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = x[s : s + n]
            links = np.array(_forest(own, _unary(own), most), np.int64).reshape(-1, 2)
            a.append(own[links[:, 0]])
            b.append(own[links[:, 1]])

    def rows(a: list, b: list | None) -> pa.RecordBatch:
        left = np.concatenate(a).view(np.int64) if a else np.zeros(0, np.int64)
        right = pa.array(np.concatenate(b).view(np.int64)) if b else pa.nulls(len(left), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(left), right], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("j", np.int32), ("c", np.int64)])
        keep_k, keep_x, hot = np.zeros(0, kind), np.zeros(0, np.uint64), None
        for batch in batches:
            k = np.empty(batch.num_rows, kind)
            k["j"], k["c"] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).to_numpy().view(np.uint64)
            if hot is not None:
                n = int(np.argmin(np.append(k == hot, False)))
                if n:
                    yield rows([x[:n]], None)
                k, x = k[n:], x[n:]
                if not len(k):
                    continue
                hot = None
            k, x = np.concatenate((keep_k, k)), np.concatenate((keep_x, x))
            if not len(k):
                continue
            last = int(np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))[-1])
            a, b = [], []
            done_k, done_x = k[:last], x[:last]
            if limit is not None and last:
                edge = np.flatnonzero(np.concatenate(([True], done_k[1:] != done_k[:-1], [True])))
                big = np.repeat(np.diff(edge) > limit, np.diff(edge))
                if big.any():
                    yield rows([done_x[big]], None)
                    done_k, done_x = done_k[~big], done_x[~big]
            if len(done_k):
                found(done_k, done_x, a, b)
                yield rows(a, b)
            keep_k, keep_x = k[last:], x[last:]
            if limit is not None and len(keep_k) > limit:
                yield rows([keep_x], None)
                hot, keep_k, keep_x = keep_k[0], keep_k[:0], keep_x[:0]
        if len(keep_k):
            a, b = [], []
            found(keep_k, keep_x, a, b)
            yield rows(a, b)

    return run


def _meet(points: DataFrame, base, chosen: list[int], most: int, limit: int | None) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), base.bitwiseAND(F.lit(m)).alias("c")) for j, m in enumerate(chosen)])).alias("cell")
    met = points.select("fp", cells).select("cell.j", "cell.c", "fp")
    return by_batches(met.repartition("j", "c").sortWithinPartitions("j", "c"), _cells(most, limit), "a bigint, b bigint")


def grouping(n: int) -> list[int]:
    """Bits of each group of segments: more groups as there are more points, so that cells stay small."""
    g = 6 if n < 4_000_000 else 8 if n < 100_000_000 else 10
    return [2 * (32 // g + (i < 32 % g)) for i in range(g)]


def links(points: DataFrame, *, most: int = 3, limit: int = CELL) -> DataFrame:
    """points: distinct fp. Links (a, b) at most bits apart; each pair that near is connected by them."""
    met = cut(_meet(points, embed(F.col("fp")), masks(grouping(points.count()), most), most, limit))
    hot = met.filter("b is null").select(F.col("a").alias("fp")).distinct()
    sound = met.filter("b is not null").distinct()
    if hot.isEmpty():
        return sound
    return sound.unionByName(_meet(hot, F.col("fp"), masks([4] * 16, most), most, None)).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sig_col: str | None = None, shingle: int = 3, most: int = 3) -> DataFrame:
    """(id_col, sig, fp, component_id) for each row: the least id reachable over links of at most `most` bits."""
    of = cut(fingerprints(docs, id_col=id_col, text_col=text_col, sig_col=sig_col, shingle=shingle))
    points = cut(of.groupBy("fp").agg(F.min(id_col).alias("__first"), F.count("*").alias("__n")))
    star = components(links(points.select("fp"), most=most))
    star = cut(star.select(F.col("node").alias("fp"), "root").join(points.select("fp", "__first"), "fp"))
    least = star.groupBy("root").agg(F.min("__first").alias("__least"), F.count("*").alias("__n"))
    star = lookup(star, least, "root", "__n").select("fp", "__least")
    small = points.join(star, "fp", "left").select("fp", F.coalesce("__least", "__first").alias("component_id"), "__n")
    return lookup(of, small, "fp", "__n", sizes=points).select(id_col, "sig", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: that with the least id (null last), of those the least hash of the whole row, once."""
    mark, count = fresh(docs, "__mark", "__count")
    marked = docs.select("*", row_mark(docs).alias(mark))
    near = near_duplicates(marked.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(mark).alias("m")), id_col="i", text_col="t", sig_col="m")
    # equal rows first, where they are: a component may be made of few rows, over and over
    near = near.groupBy("component_id", "i", "sig").agg(F.count("*").alias("n"))
    first = near.groupBy("component_id").agg(F.min(F.struct(F.col("i").isNull().alias("o"), "i", "sig", "n")).alias("m"))
    first = cut(first.select(F.col("m.sig").alias(mark), F.col("m.n").alias("n")).groupBy(mark).agg(F.sum("n").alias(count)))
    return once_each(marked, first, mark, count).select(*columns_of(docs))
