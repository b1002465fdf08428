"""From lines to typed blocks: kinds by cascade, joins of split paragraphs, and the order-dependent fold of a page."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.functions.text import list_kind
from quire.operators.sequence import islands, ordered_list

#: Characters that end a paragraph.
TERMINALS = (".", ":", "!", "?", "”")


def line_kind(s: Column) -> Column:
    """A line's kind, the first rule that fits."""
    return F.when(F.trim(s) == "", "blank").when(list_kind(s).isNotNull(), list_kind(s)).when(s.contains(" | "), "row").when(s.rlike("^[^a-z]*$"), "heading").when(s.rlike(r":\s*$"), "label").otherwise("paragraph")


#: Block type by role prefix, the first that fits; roles of body text become what their marker says.
ROLE_KINDS = (("table.", "table"), ("sidebar.title", "sidebar_title"), ("sidebar", "sidebar_body"), ("statblock.name", "statblock.name"), ("statblock.section", "statblock.section"), ("statblock.meta", "statblock.meta"), ("statblock.header", "statblock.header"), ("statblock.ability", "statblock.ability"), ("statblock", "statblock.body"), ("chapter", "heading"), ("section", "heading"), ("subsection", "heading"), ("entry", "heading"), ("subtitle", "subtitle"), ("prop.", "property"), ("callout", "callout"), ("toc", "toc"))


def block_kind(role: Column, text: Column) -> Column:
    """A block's type from its role and marker."""
    out = F.when(F.lit(False), "")
    for prefix, kind in ROLE_KINDS:
        out = out.when(role.startswith(prefix), kind)
    return out.otherwise(F.coalesce(list_kind(text), F.lit("paragraph")))


#: Kinds whose lines go on while the gap stays small and no run-in opens.
GROWING = ("subtitle", "callout", "sidebar_title", "sidebar_body", "statblock.name", "statblock.section", "statblock.meta", "statblock.header", "statblock.ability", "statblock.body")
BODY = {"paragraph", "bullet", "step", "definition"}
FOLDED = "page int, block int, seq int, kind string, role string, column int, region string, level int, text string, md string, lines int, y0 double, y1 double, x0 double, x1 double"


def folded(lines: Iterable[dict], *, block_gap: float = 6.0, indent: float = 4.0) -> Iterator[dict]:
    """One page's lines, in reading order, as blocks; only the open block is held.

    A line goes on with the open block if it has its region and column and fits: a heading goes on with
    lines of its role within 1.8 sizes; a table takes its region's lines; body text goes on while the
    gap stays small, no marker and no bold run-in opens something new and the line isn't indented
    against the line before. All else opens a block.
    """
    open_: dict | None = None
    last: dict | None = None
    for line in lines:
        kind = _kind(line)
        if open_ is not None and last is not None and _goes_on(open_, last, line, kind, block_gap, indent):
            for key in ("text", "md"):
                parts = open_[key]
                if last["text"].rstrip().endswith("­"):
                    parts[-1] = parts[-1].rstrip().rstrip("­")
                else:
                    parts.append(" ")
                parts.append(line.get(key) or line["text"])
            open_["lines"] += 1
            open_["y1"] = max(open_["y1"], line["y"])
            open_["x0"], open_["x1"] = min(open_["x0"], line["x0"]), max(open_["x1"], line["x1"])
        else:
            if open_ is not None:
                yield open_ | {"text": "".join(open_["text"]), "md": "".join(open_["md"])}
            open_ = {"seq": line["seq"], "kind": kind, "role": line["role"], "column": line["column"], "region": line["region"], "level": line.get("level"), "text": [line["text"]], "md": [line.get("md") or line["text"]], "lines": 1, "y0": line["y"] - line["size"], "y1": line["y"], "x0": line["x0"], "x1": line["x1"]}
        last = line
    if open_ is not None:
        yield open_ | {"text": "".join(open_["text"]), "md": "".join(open_["md"])}


def fold_page(lines: Iterable[dict], **limits: float) -> list[dict]:
    return list(folded(lines, **limits))


def _kind(line: dict) -> str:
    for prefix, kind in ROLE_KINDS:
        if (line["role"] or "").startswith(prefix):
            return kind
    text = line["text"].lstrip()
    if text.startswith("•"):
        return "bullet"
    head = text.split(":", 1)[0]
    if ":" in text and head.strip().isdigit():
        return "step"
    return "definition" if line.get("bold") else "paragraph"


def _goes_on(block: dict, last: dict, line: dict, kind: str, block_gap: float, indent: float) -> bool:
    if block["region"] != line["region"]:
        return False
    if kind == "table" or block["kind"] == "table":
        return kind == block["kind"]
    gap = line["y"] - last["y"]
    if block["column"] != line["column"] or gap < 0:
        return False
    if kind == "heading" or block["kind"] == "heading":
        return kind == block["kind"] and line["role"] == block["role"] and 0 < gap <= 1.8 * line["size"]
    if kind not in BODY or block["kind"] not in BODY:
        return kind == block["kind"] and kind in GROWING and gap <= line["size"] + block_gap and not (line.get("bold") and not last.get("bold_open"))
    if kind in ("bullet", "step"):
        return False
    if line.get("bold") and not (block["kind"] == "definition" and last.get("bold_open")):
        return False  # a new run-in; one that the line before left open goes on
    if gap > line["size"] + block_gap:
        return False
    return not (block["kind"] in ("paragraph", "definition") and line["x0"] - last["x0"] > indent)


def page_blocks(lines: DataFrame, **limits: float) -> DataFrame:
    """Blocks of each page from its lines (page, seq, role, text, column, region, level, size, x0, x1, y, bold, bold_open).

    The fold depends on the open block, so a page's lines come to one task in order; they stream through
    it and are never gathered.
    """
    kind = lines.schema["page"].dataType
    schema = T._parse_datatype_string(FOLDED.replace("page int", f"page {kind.simpleString()}", 1))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        made = ({"page": page, "block": k} | b for page, own in groupby(rows, key=lambda r: r["page"]) for k, b in enumerate(folded(own, **limits)))
        while out := list(islice(made, 2000)):
            yield pa.RecordBatch.from_pylist(out, arrow)

    arrow = to_arrow_schema(schema)
    return lines.repartition("page").sortWithinPartitions("page", "seq").mapInArrow(fold, schema)


def stitched(df: DataFrame, by: list[str], order: list[str], text: str, places: list[str], *, may: Column | None = None, also: list[str] | None = None) -> DataFrame:
    """Paragraphs cut by a page or column break as one: (by, run, text, n, also).

    A row goes on with the paragraph before, all of what it is by now, if that has no end mark and began
    in another place; may tells which rows are paragraphs. Places come one after the other, so a row in
    the place of the row before goes on just where that one did. also: more texts to join.
    """
    w = W.partitionBy(*by).orderBy(*order)
    moved = F.lit(False)
    for p in places:
        moved = moved | ~F.col(p).eqNullSafe(F.lag(p).over(w))
    may = F.lit(True) if may is None else may
    ended = F.rtrim(F.lag(text).over(w)).rlike("[" + "".join(TERMINALS) + "]$")
    open_ = may & F.coalesce(F.lag(may).over(w), F.lit(False)) & ~F.coalesce(ended, F.lit(True))
    at = df.withColumn("__new", F.when(~open_, True).when(moved, False))
    at = at.withColumn("__opens", F.last("__new", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    texts = [F.array_join(ordered_list(order, c), " ").alias(c) for c in (text, *(also or []))]
    return islands(at, by, order, F.col("__opens")).groupBy(*by, "run").agg(*texts, F.count("*").alias("n"), *[F.min(c).alias(c) for c in order if also is not None])
