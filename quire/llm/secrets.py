"""Secret scans: fixed patterns, and formats inferred from labelled credentials.

Labelled credentials are the matches of the fixed patterns in a sample of the documents together with
examples in published formats. For each kind a prefix tree of their symbols is folded into a
probabilistic automaton by merging states whose futures agree within Hoeffding bounds (ALERGIA).
Every token of LEAST characters or more in every document, of whatever characters, is a candidate and
is scored: its mean log likelihood under the likeliest automaton less that under a background model of
ordinary tokens. Tokens that pass become spans of kind `format`, beside those of the fixed patterns,
which always stay.

Symbols: a digit, a-f, g-z, A-F and G-Z are one symbol each, the characters of a known prefix and
all others stand for themselves. Nulls: a null text is empty and has no spans. Repeated rows are each
scanned. Ties: a score equal to MARGIN is no secret. Texts are scanned whole, however long. Other columns
pass through unread, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, by_batches

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Published credential formats, fixed values: prefix, alphabet of the rest, length of the rest.
FORMATS = {
    "aws": ("AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
    "github": ("ghp_", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 36),
    "google": ("AIza", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-", 35),
    "slack": ("xoxb-", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 40),
    "stripe": ("sk_live_", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 24),
    "sha1": ("", "0123456789abcdef", 40),
    "md5": ("", "0123456789abcdef", 32),
}
PREFIXES = tuple(p for p, _, _ in FORMATS.values() if p)
#: Characters of a token at least; what stands between its signs.
LEAST = 16
PART = re.compile(r"[^/=]{16,}")
TOKEN_IN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
#: Examples of each format, labelled matches of each kind, and symbols read of each at most.
EXAMPLES, LABELLED, LONGEST = 120, 200, 64
#: Documents looked at for labelled matches (in expectation), and bytes of each text at most.
SAMPLE_DOCS, SAMPLE_TEXT = 20_000, 1 << 18
#: Merge test, and nats per symbol by which a secret must be likelier than an ordinary token.
ALPHA, MARGIN = 0.05, 0.5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def suspicious(text: bytes) -> bool:
    """Whether any pattern or candidate can be there; exact for none."""
    if not text:
        return False
    if TOKEN_IN.search(text):
        return True
    low = text.lower()  # the other patterns' matches may be shorter than a token
    return any(w in low for w in WORDS)


def symbols(token: str, prefixes: tuple[str, ...]) -> list[str]:
    """A token's symbols; a known prefix is kept letter by letter."""
    head = next((p for p in prefixes if token.startswith(p)), "")
    kind = lambda c: "0" if c.isdigit() else "h" if c in "abcdef" else "l" if "g" <= c <= "z" else "H" if c in "ABCDEF" else "U" if "G" <= c <= "Z" else c
    return [f"={c}" for c in head] + [kind(c) for c in token[len(head) :]]


#: Characters that a symbol stands for, so that likelihoods of different symbols compare.
SIZE = {"0": 10, "h": 6, "l": 20, "H": 6, "U": 20}


class Automaton:
    """A probabilistic automaton learned by merging compatible states of a prefix tree."""

    def __init__(self, strings: list[list[str]], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        self.stop = [0]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        for s in strings:
            at = 0
            for c in s:
                self.count[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.stop.append(0)
                at = self.next[at][c]
            self.stop[at] += 1
        self._merge_all()

    def total(self, q: int) -> int:
        return self.stop[q] + self.count[q].total()

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, red: int, blue: int) -> bool:
        """Whether all futures agree; blue is the root of a tree."""
        todo = [(red, blue)]
        while todo:
            p, q = todo.pop()
            n, m = self.total(p), self.total(q)
            if self._differ(self.stop[p], n, self.stop[q], m):
                return False
            for c in self.count[p].keys() | self.count[q].keys():
                if self._differ(self.count[p][c], n, self.count[q][c], m):
                    return False
            todo += [(self.next[p][c], r) for c, r in self.next[q].items() if c in self.next[p]]
        return True

    def _fold(self, red: int, blue: int) -> None:
        todo = [(red, blue)]
        while todo:
            p, q = todo.pop()
            self.stop[p] += self.stop[q]
            self.count[p].update(self.count[q])
            for c, r in self.next[q].items():
                if c in self.next[p]:
                    todo.append((self.next[p][c], r))
                else:
                    self.next[p][c] = r

    def _merge_all(self) -> None:
        red = [0]
        while True:
            blue = [(q, c, self.next[q][c]) for q in red for c in sorted(self.next[q]) if self.next[q][c] not in red]
            if not blue:
                break
            q, c, b = blue[0]
            for r in red:
                if self._compatible(r, b):
                    self.next[q][c] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)
        self.states = len(red)

    def score(self, s: list[str]) -> float:
        """Mean log likelihood of each symbol's characters; unseen symbols get a small share."""
        at, out = 0, 0.0
        for c in s:
            n = self.total(at) if at is not None else 0
            k = self.count[at][c] if at is not None else 0
            out += math.log((k + 0.02) / (n + 1)) - math.log(SIZE.get(c, 1))
            at = self.next[at].get(c) if at is not None else None
        return out / max(1, len(s))


class Background:
    """Ordinary tokens: each symbol given the one before."""

    def __init__(self, strings: list[list[str]]):
        self.pairs, self.ones = Counter(), Counter()
        for s in strings:
            for a, b in zip(["^", *s], s, strict=False):
                self.pairs[a, b] += 1
                self.ones[a] += 1

    def add(self, pairs: dict[tuple[str, str], int]) -> None:
        for (a, b), n in pairs.items():
            self.pairs[a, b] += n
            self.ones[a] += n

    def score(self, s: list[str]) -> float:
        out = 0.0
        for a, b in zip(["^", *s], s, strict=False):
            out += math.log((self.pairs[a, b] + 0.5) / (self.ones[a] + 0.5 * 40)) - math.log(SIZE.get(b, 1))
        return out / max(1, len(s))


def examples(seed: int = 7) -> dict[str, list[str]]:
    """Made-up credentials in the published formats."""
    pick = random.Random(seed)
    return {k: [p + "".join(pick.choice(abc) for _ in range(n)) for _ in range(EXAMPLES)] for k, (p, abc, n) in FORMATS.items()}


def ordinary_examples(seed: int = 8) -> list[str]:
    """Made-up tokens that are no secrets: identifiers, slugs, dates, numbers, versions."""
    pick = random.Random(seed)
    letter = lambda: pick.choice("eeeettaaoinshrdlucmfwypbgk")
    word = lambda: "".join(letter() for _ in range(pick.randrange(2, 9)))
    number = lambda: "".join(pick.choice("0123456789") for _ in range(pick.randrange(1, 7)))
    makes = (
        lambda: pick.choice("-_/+=").join([word() for _ in range(4)] + [number()]),
        lambda: "".join(word().capitalize() for _ in range(4)) + number(),
        lambda: f"{pick.randrange(1990, 2030)}-{pick.randrange(10, 13)}-{pick.randrange(10, 29)}T{pick.randrange(10, 24)}-{pick.randrange(10, 60)}-{pick.randrange(10, 60)}Z",
        lambda: number() + number() + number() + number(),
        lambda: word().upper() + "_" + word().upper() + "_" + number() + "_" + word().upper(),
        lambda: word() * 3 + number(),
        lambda: "".join(word() for _ in range(5)),
        lambda: "".join(word().capitalize() for _ in range(4)),
        lambda: pick.choice("-_/").join(word() for _ in range(5)),
        lambda: word().upper() + "_" + word().upper() + "_" + word().upper(),
    )
    return [makes[i % len(makes)]() for i in range(60 * len(makes))]


class Formats:
    """The learned automata and their background."""

    def __init__(self, labelled: dict[str, list[str]]):
        self.prefixes = tuple(p for p, _, _ in FORMATS.values() if p)
        self.automata = {k: Automaton([symbols(s, self.prefixes) for s in own]) for k, own in sorted(labelled.items()) if own}
        self.background = Background([symbols(s, self.prefixes) for s in ordinary_examples()])

    def score(self, token: str) -> float:
        s = symbols(token, self.prefixes)
        return max((a.score(s) for a in self.automata.values()), default=-1e9) - self.background.score(s)

    def secret(self, token: str) -> bool:
        return self.score(token) > MARGIN


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the tokens, less what base spans (in order of start) cover; both are read once."""
    k = 0
    for m in TOKEN.finditer(text):
        at = m.start()
        while k < len(base) and base[k][0] < m.end():
            s, _, e = base[k]
            if s - at >= LEAST:
                yield at, s
            at = max(at, e)
            if e > m.end():  # may cover the next token too
                break
            k += 1
        if m.end() - at >= LEAST:
            yield at, m.end()


def parts(token: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what a token may hold a secret in: from a known prefix on for its format's length, what stands between signs, and each LONGEST characters of it."""
    for prefix, _, n in FORMATS.values():
        at = token.find(prefix) if prefix else -1
        while at >= 0:
            if at + len(prefix) + n <= len(token):
                yield at, at + len(prefix) + n
            at = token.find(prefix, at + 1)
    for m in PART.finditer(token):
        if m.end() - m.start() <= LONGEST:
            yield m.span()
        else:
            for at in range(m.start(), m.end() - LONGEST + 1):
                yield at, at + LONGEST


def found_in(token: str, formats: Formats) -> list[tuple[int, int]]:
    """Parts that are secrets, those that touch as one; the whole token where it is one."""
    if len(token) <= LONGEST and formats.secret(token):
        return [(0, len(token))]
    out: list[tuple[int, int]] = []
    for s, e in sorted(x for x in parts(token) if formats.secret(token[x[0] : x[1]])):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def spans(text: bytes, formats: Formats | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the fixed patterns, and those that the formats add; kind 3 is `format`. Ends exclusive, in code points."""
    if not suspicious(text):
        return [], []
    text = text.decode()
    base, more = base_spans(text), []
    if formats is not None:
        for s, e in candidates(text, base):
            more += [(s + x, 3, s + y) for x, y in found_in(text[s:e], formats)]
    return base, more


def _said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, 'format')[k]}:{s}:{e}" for s, k, e in sorted(found))


def learn(docs: DataFrame, *, text_col: str = "text", given: dict[str, list[str]] | None = None) -> Formats:
    """Automata from given (or made-up) credentials and from matches in about SAMPLE_DOCS documents chosen by hash of the text; the background from all documents."""
    n = docs.count()
    share = int((1 << 30) * min(1.0, SAMPLE_DOCS / max(1, n)))
    chosen = docs.filter((F.octet_length(text_col) <= SAMPLE_TEXT) & (F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) < share)).select(F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, tokens = [], []
            for t in as_bytes(batch.column(0)):
                if not t or not suspicious(t):
                    continue
                text = t.decode()
                base = base_spans(text)
                for m in ASSIGN.finditer(text):
                    if len(m[2]) >= 8:
                        kinds.append("assign")
                        tokens.append(m[2])
                for s, k, e in base:
                    if k:
                        kinds.append(KINDS[k])
                        tokens.append(text[s:e])
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([t[:LONGEST] for t in tokens], pa.string())], ["kind", "token"])

    found = by_batches(chosen, run, "kind string, token string").distinct()
    rank = F.row_number().over(W.partitionBy("kind").orderBy(F.xxhash64("token"), "token"))
    labelled = dict(given if given is not None else examples())
    for kind, token in sorted(found.select("kind", "token", rank.alias("k")).filter(F.col("k") <= LABELLED).select("kind", "token").collect()):
        labelled.setdefault(kind, []).append(token)
    formats = Formats(labelled)
    counts = by_batches(docs.select(F.col(text_col).alias("t")), _ordinary(docs.sparkSession.sparkContext.broadcast(formats)), "a string, b string, n bigint")
    # as many rows as there are pairs of symbols
    formats.background.add({(r["a"], r["b"]): r["n"] for r in counts.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()})
    return formats


def _ordinary(shared):
    """Counts of neighbouring symbols in the tokens of texts; secrets among them don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats, known = shared.value, {}
        for batch in batches:
            pairs: Counter = Counter()
            for t in as_bytes(batch.column(0)):
                if not t or not TOKEN_IN.search(t):
                    continue
                text = t.decode()
                base = base_spans(text) if suspicious(t) else []
                for s, e in candidates(text, base):
                    token = text[s:e]
                    own = known.get(token)
                    if own is None:
                        if len(known) >= 1 << 12:
                            known.clear()
                        symbol = symbols(token, formats.prefixes)
                        secret = formats.secret(token) or found_in(token, formats)
                        own = known[token] = [] if secret else list(zip(["^", *symbol], symbol, strict=False))
                    pairs.update(own)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())], ["a", "b", "n"])

    return run


def scanned(docs: DataFrame, formats: Formats | None, *, text_col: str = "text", redact: str | None = None, count_col: str | None = None, into: str = "__secrets") -> DataFrame:
    """docs with a struct into (counts, base_sha256, spans) in front, or with spans replaced by redact in the text."""
    shared, at, names = docs.sparkSession.sparkContext.broadcast(formats), docs.columns.index(text_col), docs.columns
    counted = names.index(count_col) if count_col is not None else None
    made = T._parse_datatype_string(f"`{into}` struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string>")
    kind = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, changed = [], as_bytes(batch.column(at)), {}
            for i, t in enumerate(texts):
                base, more = spans(t, shared.value) if t else ([], [])
                if redact is None:
                    n = Counter(k for _, k, _ in base)
                    rows.append({"n_assign": n[0], "n_access": n[1], "n_hex": n[2], "base_sha256": hashlib.sha256(_said(base).encode()).hexdigest(), "spans": _said(base + more)})
                elif base or more:
                    text, out, end = t.decode(), [], 0
                    for s, _, e in sorted(base + more):
                        if e > end:
                            if s >= end:
                                out += [text[end:s], redact]
                            end = e
                    out.append(text[end:])
                    changed[i] = "".join(out)
            if redact is None:
                yield pa.RecordBatch.from_arrays([pa.array(rows, kind), *batch.columns], [into, *batch.schema.names])
                continue
            columns = batch.columns
            if changed:
                columns[at] = pa.array([changed[i].encode() if i in changed else t for i, t in enumerate(texts)], pa.binary()).cast(batch.schema.field(at).type)
                if counted is not None:
                    old = columns[counted].to_pylist()
                    for i, t in changed.items():
                        old[i] = len(t)
                    columns[counted] = pa.array(old, batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return by_batches(docs, run, docs.schema if redact is not None else T.StructType([*made.fields, *docs.schema.fields]))


def report(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return scanned(docs, learn(docs)).select("doc_id", "__secrets.*")


def redacted(docs: DataFrame, *, text_col: str = "text", count_col: str | None = None, by: str = "[secret]") -> DataFrame:
    """docs with every secret replaced; no document goes."""
    return scanned(docs, learn(docs, text_col=text_col), text_col=text_col, redact=by, count_col=count_col)
