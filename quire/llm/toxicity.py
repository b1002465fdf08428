"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms and accents go, letters that look like Latin ones become
those, digits and signs that stand for letters become those, and l, which a 1 may stand for as well as
i, is written i. The lexicon has single words; a word's weight is a lower bound of the log odds of
being in a toxic labelled text. Aho-Corasick finds all entries at once between word borders. Exception
phrases, longer entries, take the words they cover out of the count. The weights found are added up,
normalised by the text's length, and a logistic curve fitted to the labelled texts gives the score.

Nulls: a null or empty text finds nothing and gets the score of that. Without toxic labels to learn
from the lexicon is empty and every score is 0. Repeated rows are each scored; of texts or labels of
one id one is learned from, the least. Ties: a score at the bound is toxic. Texts are scored whole,
however long. Only the text reaches a score; other columns are not read, whatever their names. Empty
tables give empty results.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, by_batches, columns_of, crc_bucket, fresh

#: Letters of other scripts that look like Latin ones, fixed values.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ɑ": "a", "ɡ": "g", "ı": "i", "ʟ": "l", "ѡ": "w", "ø": "o",
    "đ": "d", "ł": "l", "ħ": "h",
}
#: Digits and signs that stand for letters, fixed values.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
INNER = re.compile(r"(?<=[^\W_])[@$!|+](?=[^\W_])")
#: Harmless phrases with words that are otherwise counted.
EXCEPTIONS = ("trash can", "trash bin", "trash day", "clown fish", "circus clown", "stupid simple", "pond scum", "soap scum", "scum line")
#: Labelled texts to learn from, of either kind (in expectation), the longest text, and bytes of either kind at most.
SAMPLE, SAMPLE_TEXT, SAMPLE_BYTES = 3000, 1 << 18, 32 << 20
#: Different neighbours that a lexicon word needs among toxic texts, and its least weight.
SUPPORT, LEAST = 3, 1.0


class _Folding(dict):
    """Characters of one code point folded, worked out as they come."""

    def __missing__(self, code: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code)):
            if unicodedata.combining(c) or unicodedata.category(c) == "Cf":
                continue
            for x in c.lower():
                x = HOMOGLYPHS.get(x, x)
                x = SUBSTITUTES.get(x, x)
                out.append(x if x.isalnum() or x in SIGNS else " ")
        self[code] = "".join(out)
        return self[code]


_FOLD = _Folding()
_ASCII = bytes(ord(_FOLD[b]) for b in range(128)) + bytes(range(128, 256))


def fold(text: bytes) -> str:
    """Folded words, each with a blank before and after."""
    t = text.translate(_ASCII).decode() if text.isascii() else text.decode().translate(_FOLD)
    if any(s in t for s in SIGNS):
        t = INNER.sub(lambda m: SIGNS[m[0]], t)
        t = t.translate(_NO_SIGNS)
    return f" {' '.join(t.split())} "


_NO_SIGNS = {ord(s): " " for s in SIGNS}


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights = weights
        self.exceptions = [fold(x.encode()) for x in exceptions]
        self.curve = (-20.0, 0.0)
        self._build()

    def _build(self) -> None:
        self.trie = ahocorasick.Automaton()
        for w, x in self.weights.items():
            self.trie.add_word(f" {w} ", (len(w) + 2, x))
        for e in self.exceptions:
            self.trie.add_word(e, (len(e), 0.0))
        if len(self.trie):
            self.trie.make_automaton()

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def found(self, folded: str) -> float:
        """Weights of the words found and not excepted."""
        if not self.weights:
            return 0.0
        hits, spared = [], []
        for end, (n, x) in self.trie.iter(folded):
            (hits if x else spared).append((end - n + 1, end, x))
        if not spared:
            return sum(x for _, _, x in hits)
        spared.sort()
        starts, reach = [a for a, _, _ in spared], []
        for _, b, _ in spared:  # how far the exceptions that begin up to here go
            reach.append(max(b, reach[-1]) if reach else b)
        covered = lambda s, e: (k := bisect_right(starts, s)) > 0 and e <= reach[k - 1]
        return sum(x for s, e, x in hits if not covered(s, e))

    def amount(self, folded: str) -> float:
        """What is found, normalised by length: full for a hundred words, less for more."""
        words = folded.count(" ") - 1
        return self.found(folded) / math.sqrt(1 + max(0, words) / 100)

    def score(self, text: bytes | None) -> float:
        if not self.weights:
            return 0.0
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * self.amount(fold(text or b""))))))


def fit(toxic: list[bytes], clean: list[bytes], exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from labelled texts.

    A word needs SUPPORT different neighbours in toxic texts: copies of one text say nothing more than the text.
    """
    if not toxic or not clean:
        return Lexicon({}, exceptions)
    counts = [Counter(), Counter()]
    near: dict[str, set[str]] = defaultdict(set)
    folded = [[fold(t) for t in own] for own in (clean, toxic)]
    for k, own in enumerate(folded):
        for t in sorted(set(own)):
            words = t.split()
            counts[k].update(set(words))
            if k:
                for a, b in zip(["", *words], words, strict=False):
                    near[b].add(a)
    n0, n1 = len(set(folded[0])), len(set(folded[1]))
    weights = {}
    for w, c in sorted(counts[1].items()):
        c = min(c, len(near[w]))
        if c >= SUPPORT and len(w) > 1:
            low = c - 1.3 * math.sqrt(c)
            x = math.log(max(low, 0.01) / n1) - math.log((counts[0][w] + 1) / n0)
            if x >= LEAST:
                weights[w] = round(x, 4)
    made = Lexicon(weights, exceptions)
    x = np.array([made.amount(t) for own in folded for t in own])
    y = np.repeat([0.0, 1.0], [len(folded[0]), len(folded[1])])
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    a, b = -3.0, 1.0
    for _ in range(50):  # Newton with a little ridge
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -50, 50)))
        g = np.array([(share * (p - y)).sum() + 1e-3 * (a + 3), (share * (p - y) * x).sum() + 1e-3 * b])
        v = share * p * (1 - p) + 1e-9
        h = np.array([[v.sum() + 1e-3, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    made.curve = (round(float(a), 6), round(max(0.0, float(b)), 6))
    return made


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """From labels (doc_id, toxic) and the texts they are of; about SAMPLE of either kind, chosen by hash of the id."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min(F.col("toxic").cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: int((1 << 30) * min(1.0, SAMPLE / max(1, sizes.get(k, 0)))) for k in (0, 1)}
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.filter(h < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))  # 2 * SAMPLE rows
    rows = docs.filter(F.octet_length("text") <= SAMPLE_TEXT).select("doc_id", F.col("text").cast("binary").alias("t")).join(F.broadcast(known), "doc_id")
    # however often an id is there, no more rows than known has; of these, whole texts up to SAMPLE_BYTES
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("t").alias("t"))
    upto = F.sum(F.octet_length("t")).over(W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows = rows.select("*", upto.alias("upto")).filter(F.col("upto") <= SAMPLE_BYTES)
    texts: tuple[list, list] = ([], [])
    for _, t, k in sorted((r["doc_id"], bytes(r["t"]), r["toxic"]) for r in rows.collect()):
        texts[k].append(t)
    return fit(texts[1], texts[0])


def scored(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", into: str = "__toxic") -> DataFrame:
    """docs with the score in a column in front."""
    shared, at = docs.sparkSession.sparkContext.broadcast(lexicon), docs.columns.index(text_col)
    schema = docs.select(F.lit(0.0).alias(into), *columns_of(docs)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.score(t) for t in as_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.float64()), *batch.columns], [into, *batch.schema.names])

    return by_batches(docs, run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = crc_bucket("doc_id", 3) == 1
    lexicon = learn(docs, labels.filter(~held))
    return scored(docs.select("doc_id", "text"), lexicon, into="score").select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, lexicon: Lexicon, *, most: float = 0.7) -> DataFrame:
    """docs that score less than most."""
    (into,) = fresh(docs, "__toxic")
    return scored(docs, lexicon, into=into).filter(F.col(into) < most).select(*columns_of(docs))
