"""Column functions on text. All are Catalyst expressions; none runs Python on rows."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SOFT_HYPHEN, ZERO_WIDTH, NBSP, HARD_HYPHEN = "­", "​", " ", "‑"
DASHES = "−–—"
LATIN = range(0xC0, 0x250)


def _accents() -> tuple[str, str]:
    """Letters of the Latin blocks whose canonical decomposition is one base letter and marks, and those letters."""
    plain = {chr(c): "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x)) for c in LATIN}
    pairs = [(c, b) for c, b in plain.items() if b != c and len(b) == 1]
    return "".join(c for c, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _accents()


def clean(s: Column) -> Column:
    """Soft hyphens and zero-width spaces go; no-break spaces and hyphens become plain."""
    return F.translate(s, NBSP + HARD_HYPHEN + SOFT_HYPHEN + ZERO_WIDTH, " -")


def minus(s: Column) -> Column:
    """clean, with every dash a plain minus."""
    return F.translate(clean(s), DASHES, "---")


def ends_hyphenated(s: Column) -> Column:
    return s.rlike(SOFT_HYPHEN + r"\s*$")


def unaccented(s: Column) -> Column:
    """Base letters for accented Latin ones; combining marks go."""
    return F.regexp_replace(F.translate(s, _ACCENTED, _PLAIN), r"\p{M}", "")


def sort_key(s: Column) -> Column:
    return F.lower(unaccented(clean(s)))


def slugify(s: Column) -> Column:
    """Lower-case letters and digits without accents, all else single dashes inside."""
    return F.btrim(F.regexp_replace(F.lower(unaccented(clean(s))), "[^a-z0-9]+", "-"), F.lit("-"))


def squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def capitalise(s: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def label_value(s: Column) -> tuple[Column, Column]:
    """Both sides of the first colon."""
    parts = F.split(s, ":", 2)
    return F.trim(parts[0]), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))


def split_runin(s: Column) -> tuple[Column, Column]:
    """A leading bold run-in without its stop, and the rest; a null name if there is none."""
    pattern = r"^(\*{2,3})(.+?)\1\s*([\s\S]*)$"
    name = F.regexp_extract(s, pattern, 2)
    has = s.rlike(pattern)
    return F.when(has, F.rtrim(F.regexp_replace(F.trim(name), r"\.$", ""))), F.when(has, F.regexp_extract(s, pattern, 3)).otherwise(s)


def emphasised(s: Column) -> Column:
    """Texts in single stars, those in double ones not counted."""
    return F.regexp_extract_all(F.regexp_replace(s, r"\*{2,}", ""), F.lit(r"\*([^*]+)\*"), F.lit(1))


def fragment(s: Column, words: int = 8, least: int = 20) -> Column:
    """The first words, if they are long enough to look for."""
    got = F.array_join(F.slice(F.split(squeeze(s), " "), 1, words), " ")
    return F.when(F.length(got) >= least, got)


def list_split(s: Column, marks: str = "[;,]") -> Column:
    """Parts between marks, trimmed, blank ones left out."""
    return F.filter(F.transform(F.split(s, marks), lambda x: F.trim(x)), lambda x: x != "")


def without_parens(s: Column) -> Column:
    return F.regexp_replace(s, r"\s*\([^()]*\)\s*$", "")


def in_parens(s: Column) -> Column:
    return F.nullif(F.regexp_extract(s, r"\(([^()]*)\)", 1), F.lit(""))


def cell(s: Column) -> Column:
    """A Markdown table cell."""
    return F.replace(F.replace(s, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def padded(row: Column, width: Column) -> Column:
    return F.concat(row, F.array_repeat(F.lit(""), F.greatest(width - F.size(row), F.lit(0))))


def list_kind(s: Column) -> Column:
    """bullet, step or null by the text's marker."""
    return F.when(F.ltrim(s).startswith("•"), "bullet").when(s.rlike(r"^\s*\d+\s*:"), "step")


def colour(c: Column) -> Column:
    return F.format_string("#%06X", c)


def is_label(s: Column, stops: list[str]) -> Column:
    return s.rlike(r":\s*$") | F.lower(F.btrim(s, F.lit(" ."))).isin(stops)


def joined_lines(lines: Column) -> Column:
    """Lines as one text: a blank between them, none after a soft hyphen, which goes; blank lines change nothing."""

    def step(acc, x):
        blank = F.trim(F.replace(x, F.lit(SOFT_HYPHEN), F.lit(""))) == ""
        text = squeeze(clean(x))
        glue = F.when((acc["out"] == "") | acc["open"], "").otherwise(" ")
        return F.when(blank, acc).otherwise(F.struct(F.concat(acc["out"], glue, text).alias("out"), ends_hyphenated(x).alias("open")))

    return F.aggregate(lines, F.struct(F.lit("").alias("out"), F.lit(False).alias("open")), step, lambda acc: acc["out"])


def html_of(s: Column) -> Column:
    """Inline Markdown as HTML: escaped, then ***, ** and *."""
    out = F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    for marks, tag in (("\\*\\*\\*", ("<strong><em>", "</em></strong>")), ("\\*\\*", ("<strong>", "</strong>")), ("\\*", ("<em>", "</em>"))):
        out = F.regexp_replace(out, f"{marks}([^*]+){marks}", f"{tag[0]}$1{tag[1]}")
    return out
