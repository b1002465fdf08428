"""Raw pages: positioned text spans and filled rectangles, one JSON object a page."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPAN = "struct<t: string, f: string, s: double, c: int, fl: int, x: double, y: double, bbox: array<double>>"
RECT = "struct<kind: string, rect: array<double>, fill: array<double>>"
PAGE = f"page int, width double, height double, spans array<{SPAN}>, rects array<{RECT}>"
#: Least width and height of a rectangle worth keeping.
RECT_WIDTH, RECT_HEIGHT = 20.0, 4.0


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page records as JSON lines."""
    return spark.read.schema(PAGE).json(path)


def write_pages(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object or array in a file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def spans(pages: DataFrame) -> DataFrame:
    """(page, pos, t, f, s, c, fl, x, y, bbox) in reader order; blank spans go, coordinates are rounded."""
    at = pages.select("page", F.posexplode("spans").alias("pos", "s_")).select("page", "pos", "s_.*").filter(F.trim("t") != "")
    return at.select("page", "pos", "t", "f", F.bround("s", 3).alias("s"), "c", "fl", F.bround("x", 2).alias("x"), F.bround("y", 2).alias("y"), "bbox")


def rects(pages: DataFrame) -> DataFrame:
    """(page, pos, kind, x0, y0, x1, y1, fill): filled rectangles of some size."""
    at = pages.select("page", F.posexplode("rects").alias("pos", "r_")).select("page", "pos", "r_.kind", "r_.rect", "r_.fill")
    at = at.select("page", "pos", "kind", *[F.get("rect", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], "fill")
    return at.filter(F.col("fill").isNotNull() & (F.col("x1") - F.col("x0") >= RECT_WIDTH) & (F.col("y1") - F.col("y0") >= RECT_HEIGHT))


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of files, read whole by the executors."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def inventory(of: DataFrame) -> DataFrame:
    """Spans by font, size and colour, the most frequent first."""
    return of.groupBy("f", "s", "c").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "f", "s", "c")


def unknown(inventoried: DataFrame, rules: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """Styles that no rule knows."""
    r = rules.select(F.col("font").alias("r_f"), F.col("size").alias("r_s"), F.col("color").alias("r_c"))
    return inventoried.join(r, (F.col("f") == F.col("r_f")) & (F.col("c") == F.col("r_c")) & (F.abs(F.col("s") - F.col("r_s")) <= tolerance), "left_anti")


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("path", "").split(",") if p]

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.paths]

    def read(self, partition: _Part) -> Iterator[tuple]:
        import pyarrow.fs as pafs

        fs, path = pafs.FileSystem.from_uri(partition.path) if "://" in partition.path else (pafs.LocalFileSystem(), partition.path)
        if path.endswith(".pdf"):
            yield from _pdf_pages(fs, path)
            return
        with fs.open_input_stream(path) as stream:
            rest = b""
            while data := stream.read(1 << 20):
                *lines, rest = (rest + data).split(b"\n")
                yield from map(_row, filter(None, lines))
            if rest.strip():
                yield _row(rest)


def _row(line: bytes) -> tuple:
    p = json.loads(line)
    spans = [(s["t"], s["f"], float(s["s"]), s["c"], s.get("fl", 0), float(s["x"]), float(s["y"]), [float(v) for v in s.get("bbox", [])]) for s in p.get("spans", []) if s["t"].strip()]
    rects = [(r.get("kind"), [float(v) for v in r["rect"]], [float(v) for v in r["fill"]]) for r in p.get("rects", []) if r.get("fill")]
    return p["page"], float(p.get("width") or 0), float(p.get("height") or 0), spans, rects


def _pdf_pages(fs, path: str) -> Iterator[tuple]:
    """Pages of a PDF, where a reader of PDF is installed."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("no PDF reader is installed; give page records as JSON lines") from e
    with fs.open_input_file(path) as f:
        doc = fitz.open(stream=f.read(), filetype="pdf")
    for number, page in enumerate(doc, 1):
        spans = [(s["text"], s["font"], round(s["size"], 3), s["color"], s["flags"], round(s["origin"][0], 2), round(s["origin"][1], 2), [float(v) for v in s["bbox"]]) for b in page.get_text("dict")["blocks"] for line in b.get("lines", []) for s in line["spans"] if s["text"].strip()]
        rects = [("f", [float(v) for v in d["rect"]], [float(v) for v in d["fill"]]) for d in page.get_drawings() if d.get("fill")]
        yield number, page.rect.width, page.rect.height, spans, rects


class PageSource(DataSource):
    """spark.read.format("quire_pages").load(paths): page records from JSON lines or, with a reader installed, PDF; a partition for each file."""

    @classmethod
    def name(cls) -> str:
        return "quire_pages"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)
