"""Benchmark decontamination by a generalised suffix automaton.

Test items are normalised to words and put into one automaton over word numbers. Training text is
streamed through it; at each word the automaton knows the longest suffix of what was read that
occurs in an item. Where that reaches the window length, the words of the window are hit.

Nulls: a null text has no words; a null item id counts as the id "null". Items or documents without
words never match. Repeated items count once; repeated documents are each reported. Ties: a document
with exactly max_coverage of its words hit stays. Texts are read whole, however long. Other columns
pass through unchanged, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, by_batches, columns_of, cut, fresh, lookup, runs, sha_hex, slices

#: Bytes that belong to words once A-Z are lower-cased; all others become blanks.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Item words in one automaton. A larger set of items is worked through in blocks of this size.
BLOCK_WORDS = 400_000
FILTER_BITS = 1 << 22


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().translate(WORD_BYTES).split() if text else []


class Automaton:
    """Generalised suffix automaton of items, with what is needed to name the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.items = window, [name for name, _ in items]
        self.vocab: dict[bytes, int] = {b"\x01": 1}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[list[int]] = []
        for _, words in items:
            state, own = 0, []
            for w in words:
                state = self._extend(state, self.vocab.setdefault(w, len(self.vocab) + 1))
                own.append(state)
            ends.append(own)
        self._name(items, ends)
        self.least = min([min(window, len(words)) for _, words in items if words], default=window)
        self.pairs = np.zeros(FILTER_BITS, np.bool_)
        for _, words in items:
            ids = np.array([self.vocab[w] for w in words], np.int64)
            self.pairs[self._slot(ids[:-1], ids[1:])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 0x9E3779B1 + b * 0x85EBCA6B) & (FILTER_BITS - 1)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        if (q := nxt[last].get(c)) is not None:  # the string is there already, from another item
            return q if size[q] == size[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _name(self, items, ends) -> None:
        """found[state]: items with the state's suffix of window words; short[state]: whole items that end there."""
        self.found: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for i, own in enumerate(ends):
            if 0 < len(own) < self.window:
                self.short.setdefault(self.up(own[-1], len(own)), []).append((len(own), i))
            for k, state in enumerate(own):
                if k + 1 >= self.window:
                    self.found.setdefault(self.up(state, self.window), set()).add(i)

    def up(self, state: int, length: int) -> int:
        """The state that holds this state's suffix of length words."""
        while self.size[self.link[state]] >= length:
            state = self.link[state]
        return state

    def match(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of hit words, in order, and the items found."""
        nxt, link, size, window = self.next, self.link, self.size, self.window
        state = length = 0
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for i, c in enumerate(ids):
            while state and c not in nxt[state]:
                state = link[state]
                length = size[state]
            if c in nxt[state]:
                state = nxt[state][c]
                length += 1
            else:
                length = 0
            reach = 0
            if length >= window:
                reach = length
                items |= self.found[self.up(state, window)]
            if self.short:
                s = state
                while s > 0:
                    for m, item in self.short.get(s, ()):
                        if m <= length:
                            reach = max(reach, m)
                            items.add(item)
                    s = link[s]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items

    def scan(self, texts: list[bytes | None]) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
        """For each text its words' number, hit ranges of words and items.

        Only stretches in which each pair of neighbours also stands in an item can hold a window;
        all pairs are tested at once, and the automaton reads those stretches.
        """
        for a, b in slices(texts):
            joined = b" \x01 ".join((t or b"").lower().translate(WORD_BYTES) for t in texts[a:b])
            words = joined.split()
            words.append(b"\x01")
            ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))
            stops = np.flatnonzero(ids == 1)
            starts = np.concatenate(([0], stops[:-1] + 1))
            if self.least > 1:
                p, q = ids[:-1], ids[1:]
                lo, hi = runs(self.pairs[self._slot(p, q)] & (p > 1) & (q > 1))
                hi = hi + 1
            else:
                lo, hi = runs(ids > 1)
            keep = hi - lo >= self.least
            lo, hi = lo[keep], hi[keep]
            of = np.searchsorted(stops, lo)
            hits: dict[int, tuple[list, set]] = {}
            for s, e, d in zip(lo.tolist(), hi.tolist(), of.tolist(), strict=True):
                spans, items = self.match(ids[s:e].tolist())
                if spans:
                    have = hits.setdefault(d, ([], set()))
                    base = s - int(starts[d])
                    have[0].extend((x + base, y + base) for x, y in spans)
                    have[1].update(items)
            for d, n in enumerate((stops - starts).tolist()):
                yield (n, *hits.get(d, ([], set())))


def blocks_of(bench: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of BLOCK_WORDS at most, read partition by partition; a longer item goes in pieces that share window - 1 words."""
    block, size = [], 0
    rows = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).cast("binary").alias("t")).distinct()
    for name, text in rows.toLocalIterator():
        words = words_of(bytes(text) if text is not None else None)
        step = BLOCK_WORDS - window + 1
        pieces = [words[k : k + BLOCK_WORDS] for k in range(0, max(1, len(words) - window + 1), step)] if len(words) > BLOCK_WORDS else [words]
        for piece in pieces:
            if block and size + len(piece) > BLOCK_WORDS:
                yield block
                block, size = [], 0
            block.append((name, piece))
            size += len(piece)
    yield block


_HITS = "{} struct<n_words: bigint, starts: array<int>, ends: array<int>, items: array<string>>"
_HIT_TYPE = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def automata(spark: SparkSession, bench: DataFrame, item_id: str, item_text: str, window: int) -> Iterator[Broadcast]:
    """An automaton for each block of items, broadcast: BLOCK_WORDS bounds its size."""
    for block in blocks_of(bench, item_id, item_text, window):
        yield spark.sparkContext.broadcast(Automaton(block, window))


def find(docs: DataFrame, bench: DataFrame | list[Broadcast], *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, into: str = "__hits") -> DataFrame:
    """docs with a struct column into: n_words, starts and ends of hit ranges of words, items (sorted ids).

    bench: the items, or their automata. With one block nothing is shuffled. With more, each block gives rows only for texts with hits, which meet by the text's digest.
    """
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(_HITS.format(f"`{into}`")).fields])

    def scanned(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sam = shared.value
            for batch in batches:
                rows = []
                for n, spans, items in sam.scan(as_bytes(batch.column(at))):
                    spans = _merged(spans)
                    rows.append({"n_words": n, "starts": [s for s, _ in spans], "ends": [e for _, e in spans], "items": sorted({sam.items[i] for i in items})})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _HIT_TYPE)], [*batch.schema.names, into])

        return run

    made = []
    for shared in automata(spark, bench, item_id, item_text, window) if isinstance(bench, DataFrame) else bench:
        made.append(by_batches(docs, scanned(shared), schema))
    if len(made) == 1:
        return made[0]
    key, got = fresh(docs, "__digest", "__got")
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias(key)
    hits = None
    for one in made:
        one = one.select(digest, F.col(into)).filter(F.size(f"{into}.starts") > 0).groupBy(key).agg(F.first(into).alias(into))
        hits = one if hits is None else hits.unionByName(one)
    found = F.struct(F.flatten(F.collect_list(f"{into}.starts")).alias("s"), F.flatten(F.collect_list(f"{into}.ends")).alias("e"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{into}.items")))).alias("i"))
    hits = cut(hits.groupBy(key).agg(found.alias(got)))
    # a text of very many copies, with hits or without, stays where it is
    copies = docs.select(digest).groupBy(key).agg(F.count("*").alias("n"))
    base = lookup(made[0].withColumn(key, digest), hits, key, "n", sizes=copies)
    spans = F.aggregate(
        F.array_sort(F.arrays_zip(F.col(f"{got}.s").alias("s"), F.col(f"{got}.e").alias("e"))),
        F.expr("cast(array() as array<struct<s: int, e: int>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["e"] >= x["s"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["s"].alias("s"), F.greatest(F.try_element_at(acc, F.lit(-1))["e"], x["e"]).alias("e"))))).otherwise(F.concat(acc, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))),
    )
    merged = F.when(F.col(got).isNull(), F.col(into)).otherwise(F.struct(F.col(f"{into}.n_words").alias("n_words"), spans["s"].alias("starts"), spans["e"].alias("ends"), F.col(f"{got}.i").alias("items")))
    return base.select(*columns_of(docs), merged.alias(into))


def report(docs: DataFrame, bench: DataFrame, *, window: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Per document: words, hit words, items and their digest, whether contaminated."""
    hit = F.coalesce(F.aggregate(F.zip_with("__hits.ends", "__hits.starts", lambda e, s: (e - s).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    return find(docs.select(id_col, "text"), bench, window=window).select(
        id_col,
        F.col("__hits.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("__hits.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _without(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The text less its hit words and what stands between them."""
    low = text.lower().translate(WORD_BYTES)
    out, at, k, i, n = [], 0, 0, 0, len(low)
    for s, e in zip(starts, ends, strict=True):
        first = None
        while k < e:
            while i < n and low[i] == 0x20:
                i += 1
            j = low.find(b" ", i)
            j = n if j < 0 else j
            if k == s:
                first = i
            i, k = j, k + 1
        out.append(text[at:first])
        at = i
    out.append(text[at:])
    return b"".join(out)


def decontaminate(docs: DataFrame, bench: DataFrame, *, window: int = 10, max_coverage: float = 0.5, text_col: str = "text", count_col: str | None = None, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without hit spans; a document of whose words more than max_coverage are hit goes altogether.

    count_col, if given, is set to the new text's number of code points where the text changed.
    """
    at, names = docs.columns.index(text_col), docs.columns
    counted = names.index(count_col) if count_col is not None else None
    shared = list(automata(docs.sparkSession, bench, item_id, item_text, window))

    def cleaned(batch: pa.RecordBatch, hits: Iterator[tuple[int, list[int], list[int]]]) -> pa.RecordBatch:
        texts, keep, changed = as_bytes(batch.column(at)), [], {}
        for i, (n, starts, ends) in enumerate(hits):
            hit = sum(ends) - sum(starts)
            keep.append(hit <= max_coverage * n)
            if hit and keep[-1]:
                changed[i] = texts[i] = _without(texts[i], starts, ends)
        columns = batch.columns[: len(names)]
        if changed:
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            if counted is not None:
                old = columns[counted].to_pylist()
                for i, t in changed.items():
                    old[i] = len(t.decode())
                columns[counted] = pa.array(old, batch.schema.field(counted).type)
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = ((n, _merged(s)) for n, s, _ in one.value.scan(as_bytes(batch.column(at))))
            yield cleaned(batch, ((n, [x for x, _ in s], [y for _, y in s]) for n, s in spans))

    def afterwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cleaned(batch, ((h["n_words"], h["starts"], h["ends"]) for h in batch.column(len(names)).to_pylist()))

    if len(shared) == 1:
        one = shared[0]
        return by_batches(docs, at_once, docs.schema)
    return by_batches(find(docs, shared, window=window, text_col=text_col, into=fresh(docs, "__hits")[0]), afterwards, docs.schema)


def items_digest(items: list[str]) -> str:
    return sha_hex(",".join(sorted(items)))
