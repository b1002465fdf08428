"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are read in chunks of CHUNK bytes that overlap by half and cover all of it. Learned
filters of WIDTH bytes slide over each chunk; a filter is a table of weights by place and byte value,
so that applying it is a sum of look-ups. Each filter's rectified response is max-pooled over the
chunk; the chunks' mean and greatest responses are combined by a logistic unit into one probability.

Training: stochastic gradient steps (Adam) on a bounded, stratified sample of labelled texts, with a
fixed seed. Texts of the sample are read whole. Nulls: a null text is empty; the empty text is one
chunk of padding and has a score like any other. Without two kinds of labels to learn from, the score
is the share of label 1 (0.5 if there are none). Repeated rows are each scored; of texts or labels of
one id one is learned from, the least. Ties: a score at the bound counts as label 1. Only the text
reaches a score; other columns are not read, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, by_batches, columns_of, crc_bucket, fresh, slices

WIDTH, FILTERS, CHUNK = 5, 16, 256
HALF = CHUNK // 2
#: Labelled texts of each kind (in expectation), and the longest text among them in bytes.
SAMPLE, SAMPLE_TEXT = 700, 1 << 14
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.01, 5


class Network:
    def __init__(self, seed: int = SEED):
        pick = np.random.default_rng(seed)
        self.table = (pick.standard_normal((WIDTH, 256, FILTERS)) * 0.3).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = (pick.standard_normal(2 * FILTERS) * 0.1).astype(np.float32)
        self.offset = np.float32(0)

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Each filter's response at each place; data has WIDTH - 1 bytes more than places."""
        n = len(data) - WIDTH + 1
        z = np.take(self.table[0], data[:n], axis=0)
        for k in range(1, WIDTH):
            z += np.take(self.table[k], data[k : k + n], axis=0)
        return z

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        """Mean and greatest pooled responses of each text."""
        out = np.empty((len(texts), 2 * FILTERS), np.float32)
        pad = b"\0" * (WIDTH - 1)
        for a, b in slices(texts, 1 << 17):
            own = [(t or b"\0") for t in texts[a:b]]
            data = np.frombuffer(pad.join(own) + pad, np.uint8)
            size = np.fromiter(map(len, own), np.int64, len(own))
            start = np.cumsum(size + WIDTH - 1) - size - WIDTH + 1
            blocks = -(-size // HALF)
            first = np.cumsum(blocks) - blocks
            which = np.repeat(np.arange(len(own)), blocks)
            begin = start[which] + (np.arange(blocks.sum()) - first[which]) * HALF
            stop = np.minimum(begin + HALF, (start + size)[which])
            most = np.empty((len(begin), FILTERS), np.float32)
            step = max(1, (1 << 15) // HALF)
            for i in range(0, len(begin), step):  # blocks that fit the cache
                lo, hi = begin[i], stop[min(i + step, len(begin)) - 1]
                z = self.responses(data[lo : hi + WIDTH - 1])
                most[i : i + step] = np.maximum.reduceat(z, begin[i : i + step] - lo, axis=0) if _tight(begin[i : i + step], stop[i : i + step]) else np.maximum.reduceat(np.concatenate((z, z[:1])), np.stack([begin[i : i + step], stop[i : i + step]], 1).reshape(-1) - lo, axis=0)[::2]  # a row more, so that the last block can end
            pair = most.copy()
            last = np.zeros(len(begin), bool)
            last[first + blocks - 1] = True
            pair[:-1][~last[:-1]] = np.maximum(most[:-1], most[1:])[~last[:-1]]
            pair = np.maximum(pair + self.bias, 0)
            keep = ~last | (blocks[which] == 1)  # chunks: neighbouring blocks, or the only block
            pair, of = pair[keep], which[keep]
            edge = np.searchsorted(of, np.arange(len(own)))
            n = np.diff(np.append(edge, len(of)))
            out[a:b, :FILTERS] = np.add.reduceat(pair, edge, axis=0, dtype=np.float64) / n[:, None]
            out[a:b, FILTERS:] = np.maximum.reduceat(pair, edge, axis=0)
        return out

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = self.features(texts).astype(np.float64) @ self.out.astype(np.float64) + float(self.offset)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def train(self, texts: list[bytes], y: np.ndarray, *, epochs: int = EPOCHS, seed: int = SEED) -> None:
        pick = np.random.default_rng(seed)
        share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        made = [_chunks(t) for t in texts]
        names = ("table", "bias", "out", "offset")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        t = 0
        for _ in range(epochs):
            order = pick.permutation(len(texts))
            for s in range(0, len(order), BATCH):
                rows = order[s : s + BATCH]
                data = np.concatenate([made[r][0] for r in rows])
                places = np.concatenate([made[r][1] for r in rows])
                n = np.array([len(made[r][0]) for r in rows])
                grads = self._gradients(data, places, n, y[rows], share[rows])
                t += 1
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.99 * v[k] + 0.01 * grads[k] ** 2
                    move = RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)
                    setattr(self, k, (getattr(self, k) - move).astype(np.float32))

    def _pooled(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each chunk's filters respond most, and how much; places past a chunk's own don't count."""
        z = self.table[0][data[:, :CHUNK]]
        for k in range(1, WIDTH):
            z += self.table[k][data[:, k : k + CHUNK]]
        z[np.arange(CHUNK) >= places[:, None]] = -np.inf
        at = z.argmax(1)
        return at, np.take_along_axis(z, at[:, None], 1)[:, 0] + self.bias

    def _gradients(self, data: np.ndarray, places: np.ndarray, n: np.ndarray, y: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        """data: (chunks, CHUNK + WIDTH - 1) bytes of a batch's texts, places in each chunk, n chunks of each text."""
        at, top = self._pooled(data, places)
        live = np.maximum(top, 0)
        edge = np.cumsum(n) - n
        of = np.repeat(np.arange(len(n)), n)
        mean = np.add.reduceat(live, edge, axis=0) / n[:, None]
        peak = np.maximum.reduceat(live, edge, axis=0)
        feats = np.concatenate([mean, peak], 1)
        p = 1 / (1 + np.exp(-np.clip(feats @ self.out + self.offset, -30, 30)))
        d = (share * (p - y) / len(y)).astype(np.float32)
        back = (d / n)[of][:, None] * self.out[:FILTERS] + (live == peak[of]) * d[of][:, None] * self.out[FILTERS:]
        back = back * (top > 0)
        table = np.zeros_like(self.table)
        row, col = np.arange(len(data))[:, None], np.arange(FILTERS)
        for k in range(WIDTH):
            np.add.at(table[k], (data[row, at + k], col), back)
        return {"table": table, "bias": back.sum(0), "out": d @ feats + 1e-4 * self.out, "offset": d.sum()}


def _tight(begin: np.ndarray, stop: np.ndarray) -> bool:
    return bool((begin[1:] == stop[:-1]).all())


def _chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's overlapping chunks, and how many places each has: as many as score() pools."""
    data = np.frombuffer((text or b"\0") + b"\0" * (WIDTH - 1), np.uint8)
    places = len(data) - WIDTH + 1
    starts = np.arange(max(1, -(-places // HALF) - 1)) * HALF
    whole = np.zeros((len(starts), CHUNK + WIDTH - 1), np.uint8)
    for i, s in enumerate(starts):
        piece = data[s : s + CHUNK + WIDTH - 1]
        whole[i, : len(piece)] = piece
    return whole, np.minimum(places - starts, CHUNK)


class Constant:
    """Stands in where there is nothing to learn."""

    def __init__(self, value: float):
        self.value = value

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        return np.full(len(texts), self.value)


def learn(docs: DataFrame, labels: DataFrame, *, label: str = "quality") -> Network | Constant:
    """From labels (doc_id, label 0 or 1) and the texts they are of; about SAMPLE of either kind, chosen by hash of the id."""
    known = labels.filter(f"doc_id is not null and `{label}` in (0, 1)").groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Constant(float(next(iter(sizes), 0.5)))
    share = {k: int((1 << 30) * min(1.0, SAMPLE / sizes[k])) for k in (0, 1)}
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.filter(h < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))  # 2 * SAMPLE rows
    rows = docs.filter(F.octet_length("text") <= SAMPLE_TEXT).select("doc_id", F.col("text").cast("binary").alias("t")).join(F.broadcast(known), "doc_id")
    # however often an id is there: no more rows than known has, of SAMPLE_TEXT bytes at most
    got = sorted((r["doc_id"], bytes(r["t"]), r["y"]) for r in rows.groupBy("doc_id", "y").agg(F.min("t").alias("t")).collect())
    y = np.array([g[2] for g in got], np.float32)
    if not 0 < y.sum() < len(y):
        return Constant(float(y.mean()) if len(y) else sizes[1] / (sizes[0] + sizes[1]))
    net = Network()
    net.train([g[1] for g in got], y, epochs=max(EPOCHS, min(40, 4000 // len(y))))
    return net


def scored(docs: DataFrame, net: Network | Constant, *, text_col: str = "text", into: str = "__quality") -> DataFrame:
    """docs with the score in a column in front."""
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index(text_col)
    schema = docs.select(F.lit(0.0).alias(into), *columns_of(docs)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shared.value.score(as_bytes(batch.column(at)))
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.float64()), *batch.columns], [into, *batch.schema.names])

    return by_batches(docs, run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = crc_bucket("doc_id", 5) == 0
    net = learn(docs, labels.filter(~held))
    return scored(docs.select("doc_id", "text"), net, into="score").select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, net: Network | Constant, *, least: float = 0.3) -> DataFrame:
    """docs that score least or more."""
    (into,) = fresh(docs, "__quality")
    return scored(docs, net, into=into).filter(F.col(into) >= least).select(*columns_of(docs))
