"""Language identification by prediction by partial matching.

For each language a variable-order byte context tree is counted over a sample of labelled texts and
then frozen. A text's exact code length under each tree (escape method C with exclusion) is the sum
over all its bytes; the shortest code names the language.

Before coding, A-Z are lower-cased and runs of other ASCII bytes than letters become one blank; all
other bytes are coded as they are. Nulls: a null text, or one without a letter, is `und` with score
0. A null language is never learned from. With nothing to learn from, every text is `und`. Ties go to
the first language by name. Repeated rows are each scored, and learned from once. Texts are scored
whole, however long. Only the text reaches the prediction; other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, by_batches, columns_of, crc_bucket, fresh, slices

FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Context bytes at most.
ORDER = 3
#: Bytes of text to learn from, for each language and for all together, and the longest text among them.
SAMPLE_BYTES, SAMPLE_ALL, SAMPLE_TEXT = 1 << 20, 12 << 20, 1 << 18
#: Languages at most, and entries of the table of code lengths: with more languages there are fewer contexts.
LANGUAGES, ENTRIES = 20_000, 24_000_000
BREAK = b" " * ORDER


def folded(text: bytes) -> bytes:
    return b" ".join(text.translate(FOLD).split())


class Trees:
    """Code lengths in bits by (context, symbol, language)."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER, entries: int = ENTRIES):
        self.names = sorted(texts)
        if not texts:
            return
        streams = {name: np.frombuffer(BREAK + BREAK.join(map(folded, own)), np.uint8) for name, own in texts.items()}
        seen = np.unique(np.concatenate([*streams.values(), np.frombuffer(b" ", np.uint8)]))
        self.order, self.width = order, len(seen) + 1  # the last symbol stands for bytes never seen
        self.symbol = np.full(256, len(seen), np.int64)
        self.symbol[seen] = np.arange(len(seen))
        width, langs = self.width, len(self.names)
        coded = {name: self.symbol[s] for name, s in streams.items()}
        most = max(1, entries // (width * langs))
        # Contexts by order: their codes (digits to the base width) and nodes; the root is node 0.
        levels = [np.zeros(1, np.int64)]
        for k in range(1, order + 1):
            codes, counts = np.unique(np.concatenate([self._codes(c, k) for c in coded.values()]), return_counts=True)
            room = most - sum(map(len, levels))
            keep = counts >= 2
            if keep.sum() > room:
                keep &= counts > np.sort(counts)[-max(room, 1)]
            # a context's suffix must be there too
            parent = codes % width ** (k - 1)
            keep &= np.isin(parent, levels[k - 1])
            levels.append(codes[keep])
        base = np.cumsum([0, *map(len, levels)])
        nodes = int(base[-1])
        self.bits = np.empty((langs, nodes * width), np.float32)
        for lang, name in enumerate(self.names):
            stream, p = coded[name], np.empty((nodes, width))
            for k, codes in enumerate(levels):
                count = np.zeros((len(codes), width))
                if len(stream) > k:
                    full, n = np.unique(self._codes(stream, k + 1), return_counts=True)
                    at = np.searchsorted(codes, full // width)
                    ok = at < len(codes)
                    ok[ok] = codes[at[ok]] == full[ok] // width
                    count[at[ok], full[ok] % width] = n[ok]
                lower = np.full((1, width), 1 / width) if k == 0 else p[base[k - 1] + np.searchsorted(levels[k - 1], codes % width ** (k - 1))]
                total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
                rest = np.where(count > 0, 0, lower).sum(1, keepdims=True)
                escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1) / np.maximum(rest, 1e-300)
                full_row = (kinds == width) & (total > 0)  # nothing to escape to
                seen_p = np.where(full_row, count / np.maximum(total, 1), count / np.maximum(total + kinds, 1))
                p[base[k] : base[k + 1]] = np.where(count > 0, seen_p, lower * escape)
            self.bits[lang] = -np.log2(p).reshape(-1)
        # The longest known suffix of any ORDER symbols.
        node = np.zeros(1, np.int32)
        for k in range(1, order + 1):
            node = np.tile(node, width)
            node[levels[k]] = base[k] + np.arange(len(levels[k]), dtype=np.int32)
        self.node = node

    def _codes(self, stream: np.ndarray, n: int) -> np.ndarray:
        """Codes of all runs of n symbols; the first symbol has the most weight."""
        out = np.zeros(max(0, len(stream) - n + 1), np.int64)
        for i in range(n):
            out *= self.width
            out += stream[i : len(stream) - n + 1 + i]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits to code each text (folded before), by language."""
        joined = np.frombuffer(BREAK + BREAK.join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        s = self.symbol[joined]
        at = self.node[self._codes(s, self.order)[:-1]].astype(np.int64) * self.width + s[self.order :]
        start = np.cumsum(size + self.order) - size - self.order
        out = np.zeros((len(texts), len(self.names)))
        ok = size > 0
        edges = np.stack([start[ok], start[ok] + size[ok]], 1).reshape(-1)
        if not len(edges):
            return out
        if edges[-1] == len(at):
            edges = edges[:-1]
        for lang in range(len(self.names)):
            out[ok, lang] = np.add.reduceat(self.bits[lang][at], edges, dtype=np.float64)[::2]
        return out

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.names:
            return names, scores
        for a, b in slices(texts, 1 << 20):
            rows, own = [], []
            for i in range(a, b):
                if texts[i]:
                    t = folded(texts[i])
                    if has_letter(t):
                        rows.append(i)
                        own.append(t)
            if not rows:
                continue
            bits = self.lengths(own)
            best = bits.argmin(1)
            odds = np.exp2(np.clip(bits[np.arange(len(best)), best][:, None] - bits, -1000, 0)).sum(1)
            for i, lang, x in zip(rows, best.tolist(), (1 / odds).tolist(), strict=True):
                names[i], scores[i] = self.names[lang], x
        return names, scores


LETTERS = bytes(range(0x61, 0x7B))


def has_letter(text: bytes) -> bool:
    """Whether a folded text has a letter of any script."""
    other = text.translate(None, LETTERS)
    return len(other) < len(text) or any(c.isalpha() for c in other.decode("utf-8", "replace"))


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Trees:
    """Trees from a sample of rows with language and text, chosen by hash: about SAMPLE_BYTES for each language.

    The bound: LANGUAGES languages, SAMPLE_ALL bytes in all (in expectation), texts of SAMPLE_TEXT bytes at most.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= SAMPLE_TEXT)).select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)).alias("h"))
    sizes = rows.groupBy("l").agg(F.sum(F.octet_length("t")).alias("n")).orderBy(F.desc("n"), "l").limit(LANGUAGES).collect()
    room = min(SAMPLE_BYTES, SAMPLE_ALL // max(1, len(sizes)))
    texts: dict[str, list[bytes]] = {}
    if sizes:
        share = docs.sparkSession.createDataFrame([(r["l"], min(1 << 30, int((1 << 30) * room / max(1, r["n"])))) for r in sizes], "l string, share long")
        chosen = rows.join(F.broadcast(share), "l").filter("h < share").select("l", "h", F.col("t").cast("binary").alias("t"))
        for r in sorted(chosen.groupBy("l", "h").agg(F.min("t").alias("t")).collect()):  # a repeated text once
            texts.setdefault(r["l"], []).append(bytes(r["t"]))
    return Trees(texts)


def predict(docs: DataFrame, trees: Trees, *, text_col: str = "text", into: str = "__lang") -> DataFrame:
    """docs with lang_pred and score in front of its own columns, as a struct column into."""
    shared, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text_col)
    schema = docs.select(F.struct(F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).alias(into), *columns_of(docs)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(as_bytes(batch.column(at)))
            made = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([made, *batch.columns], [into, *batch.schema.names])

    return by_batches(docs, run, schema)


def report(docs: DataFrame) -> DataFrame:
    held = crc_bucket("doc_id", 4) == 2
    trees = learn(docs.filter(~held))
    return predict(docs.select("doc_id", "text"), trees).select("doc_id", held.alias("held_out"), "__lang.lang_pred", "__lang.score")


def keep_known(docs: DataFrame) -> DataFrame:
    """docs less those that no language is found for."""
    (into,) = fresh(docs, "__lang")
    found = predict(docs, learn(docs.filter(crc_bucket("doc_id", 4) != 2)), into=into)
    return found.filter(F.col(into)["lang_pred"] != "und").select(*columns_of(docs))
