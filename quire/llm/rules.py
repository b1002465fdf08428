"""Quality rules with adaptive thresholds.

Each text is measured: mean length of a word, and rates of symbols, repeated lines and repeated word
windows. A rate counts one event more than the text has, over as much more room, so that a single
event in a short text is nothing out of the way and texts without events still differ. Measures of the
documents that pass the base rule go into quantile sketches, one for each language, source and
measure. A sketch counts values rounded down to eight significant bits, so sketches merge by adding
counts, in any order and partitioning, and a quantile is off by a 256th at most.

A threshold is a fence: the upper quartile plus `spread` times the distance of the quartiles; for word
length there is a lower fence too. No other figure decides. Quartiles of a language and source are
drawn towards the language's, and those towards all documents', by weight: a sketch's own documents
against PRIOR. Thresholds are joined back and decide; a measure that ties with its fence passes.

DataFrame functions only. Nulls: a null text has no words and fails the base rule; null languages and
sources are groups of their own. Repeated rows are each counted and each judged. Texts are read whole,
however long; the arrays of one text must fit a row. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import columns_of, cut, fresh, lookup, row_mark
from quire.llm.mixing import words_of

#: Measures in thousandths: numerator, denominator, one event in units of the numerator, whether low values fail too.
#: A repeated window of three words makes six repeated words.
MEASURES = {
    "length": ("word_chars", "n_words", 0, True),
    "symbols": ("n_symbols", "n_words", 1, False),
    "lines": ("n_dup_lines", "n_lines", 1, False),
    "repeats": ("n_repeat_words", "n_words", 6, False),
}
SPREAD, PRIOR, BITS = 4, 50, 8
#: Base rule: words at least, and hundredths of words in repeated windows at most.
MIN_WORDS, MAX_REPEAT = 50, 50


def measured(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep's columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Windows of three words are compared by 64-bit hash and place: sorted together, equal neighbours
    are repeats. All is done within the row, without exploding.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    at = docs.select(*(keep or []), words_of(F.col(text_col)).alias("__w"), lines.alias("__l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"))
    grams = F.when(F.size("__w") > 2, F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    at = at.select(
        *(keep or []),
        "n_symbols",
        F.size("__w").cast("bigint").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
        F.size("__l").cast("bigint").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        grams.alias("__g"),
    )
    names = [*(keep or []), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    placed = F.sort_array(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    at = at.select(*names, F.when(F.size(F.array_distinct("__g")) < F.size("__g"), placed).otherwise(none).alias("__s"))
    twice = F.transform("__s", lambda x, i: F.when((x["h"] == F.get("__s", i - 1)["h"]) | (x["h"] == F.get("__s", i + 1)["h"]), x["i"]))
    at = at.select(*names, F.when(F.size("__s") > 0, F.sort_array(F.filter(twice, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<int>")).alias("__p"))
    covered = F.transform("__p", lambda p, i: F.least(F.coalesce(F.get("__p", i + 1) - p, F.lit(3)), F.lit(3)).cast("bigint"))
    return at.select(*names, F.when(F.size("__p") > 0, F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)).otherwise(0).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def value(measure: str) -> Column:
    top, under, event, _ = MEASURES[measure]
    return F.expr(f"({top} + {event}) * 1000 div greatest({under} + {event}, 1)")


def rounded(v: Column) -> Column:
    """v, not negative, with its BITS highest bits only: what the sketch keeps."""
    drop = F.greatest(F.length(F.bin(v)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, v, n): the counts of each sketch."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), rounded(value(m)).alias("v")) for m in MEASURES])).alias("x")
    return rows.select(*by, each).groupBy(*by, "x.measure", "x.v").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "measure", "v").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, docs, q1, q3) of each sketch."""
    of = W.partitionBy(*by, "measure")
    at = sketch.select("*", F.sum("n").over(of).alias("docs"), F.sum("n").over(of.orderBy("v")).alias("c"))
    quartile = lambda q: F.min(F.when(4 * F.col("c") >= q * F.col("docs"), F.col("v")))
    return at.groupBy(*by, "measure").agg(F.max("docs").alias("docs"), quartile(1).alias("q1"), quartile(3).alias("q3"))


def drawn(one: DataFrame, parent: DataFrame, by: list[str], prior: int = PRIOR) -> DataFrame:
    """Quartiles drawn towards the parent's: its own documents weigh against prior ones like the parent's."""
    up = parent.select(*by, "measure", F.col("q1").alias("p1"), F.col("q3").alias("p3"))
    both = lambda q, p: F.expr(f"(docs * {q} + {prior} * {p}) div (docs + {prior})").alias(q)
    return one.join(up, [*by, "measure"]).select(*one.drop("q1", "q3").columns, both("q1", "p1"), both("q3", "p3"))


def fences(sketch: DataFrame, *, prior: int = PRIOR, spread: int = SPREAD) -> DataFrame:
    """sketch by l and g (a language, and a source of it). (g, {measure}_low, {measure}_high)."""
    whole = quartiles(merged(sketch, []), [])
    langs = drawn(quartiles(merged(sketch, ["l"]), ["l"]), whole, [], prior)
    own = drawn(quartiles(sketch, ["l", "g"]), langs, ["l"], prior)
    wide = spread * (F.col("q3") - F.col("q1"))
    out = []
    for m in MEASURES:
        out += [F.max(F.when(F.col("measure") == m, F.col("q1") - wide)).alias(f"{m}_low"), F.max(F.when(F.col("measure") == m, F.col("q3") + wide)).alias(f"{m}_high")]
    return own.groupBy("g").agg(*out)


def judged(rows: DataFrame, *, lang: str = "lang", source: str = "source") -> DataFrame:
    """rows (measured, with lang and source) with base_failed and kept."""
    # one text for each pair: nulls and any characters stay apart
    coded = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (lang, source)]
    rows = cut(rows.select("*", coded[0].alias("l"), F.concat(*coded).alias("g"), base_failed().alias("base_failed")))
    sketch = cut(sketches(rows.filter("not base_failed"), ["l", "g"]))
    counts = rows.groupBy("g").agg(F.count("*").alias("__n"))
    names = [f"{m}_{end}" for m in MEASURES for end in ("low", "high")]
    small = counts.join(fences(sketch), "g", "left")
    at = lookup(rows, small, "g", "__n", sizes=counts)
    ok = F.lit(True)
    for m, (_, _, _, low) in MEASURES.items():
        ok = ok & (value(m) <= F.col(f"{m}_high"))
        if low:
            ok = ok & (value(m) >= F.col(f"{m}_low"))
    return at.select("*", (~F.col("base_failed") & F.coalesce(ok, F.lit(False))).alias("kept")).drop("g", "l", "__n", *names)


def report(docs: DataFrame) -> DataFrame:
    rows = measured(docs, keep=["doc_id", "lang", "source"])
    return judged(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """docs that are kept; equal rows are judged alike."""
    (mark,) = fresh(docs, "__mark")
    marked = docs.select("*", row_mark(docs).alias(mark))
    narrow = marked.select(F.col(mark).alias("mark"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    good = judged(measured(narrow, keep=["mark", "lang", "source"])).filter("kept").select(F.col("mark").alias(mark)).distinct()
    return marked.join(good, mark, "left_semi").select(*columns_of(docs))
