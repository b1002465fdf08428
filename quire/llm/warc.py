"""Deterministic sharded WARC writer and its reader.

Records are sorted by page id into shards. Shard borders come from a histogram of ids weighted by
payload bytes, in two levels and cumulated on the cluster, so they are the same for any partitioning;
one border a shard comes to the driver, and rows find their shard by binary search. A shard is written by one task as gzip
members of one record each; a file is closed once its compressed size reaches the limit. Headers,
record ids and digests are made anew from id, address and payload. Tasks write under temporary
names and report their files; the report is committed as a table, files are then renamed by it and a
marker ends the archive. A task or executor lost on the way leaves at most a stray temporary file.

Of records with equal payloads (of min_revisit bytes or more) the one with the largest page id is a
response; the others are revisits that refer to it, by its page id, address, date and record id.
Nulls: null html is an empty payload; a null page id sorts first, and refers_to is null if it is the
response's. Null and empty addresses become urn:page:ID. Ties: of pages of one id the greatest address
is the response's, of wholly equal rows the first written; their records are numbered, so that no two
have one id. Payloads are held whole, one at a time. Empty tables give an archive without records.
Other columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import by_batches, cut, heavy_keys, lookup, shared_dir

#: Raw bytes of a shard at least; shards at most; ids' histogram bars at each of two levels.
SHARD_BYTES, SHARDS, BARS = 32 << 20, 50_000, 4096
ROLL_BYTES = 64 << 20
#: Records of equal pages that are written together, where one page has very many.
TOGETHER = 10_000
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
OVERHEAD = 600
FILES = "shard int, seq int, temp string, name string, records bigint, bytes bigint, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def _record(kind: str, uri: str, headers: list[tuple[str, str]], block: bytes, key: str) -> bytes:
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", uri)] if uri else []),
        *headers,
        ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
        ("Content-Length", str(len(block))),
    ]
    raw = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + CRLF + block + CRLF + CRLF
    return gzip.compress(raw, 6, mtime=0)


def _uri(url: str | None, page: str) -> str:
    if not url:
        return f"urn:page:{page}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _name(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


def page_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers: tuple[int | None, str | None] | None, copy: int = 0) -> bytes:
    """The record of one page: a response, or a revisit if refers holds the response's page id and address. copy tells equal pages apart."""
    page = _name(page_id)
    uri = _uri(url, page)
    key = f"{page} {url or ''} {digest}" + (f" {copy}" if copy else "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    own = [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", page), ("X-Payload-Length", str(size)), ("Content-Type", "application/http;msgtype=response")]
    if refers is None:
        return _record("response", uri, own, http + payload, key)
    other = _name(refers[0])
    target = _uri(refers[1], other)
    own += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(f"{other} {refers[1] or ''} {digest}")),
        ("WARC-Refers-To-Target-URI", target),
        ("WARC-Refers-To-Date", DATE),
        ("X-Refers-To-Page-ID", other),
    ]
    return _record("revisit", uri, own, http, key + " revisit")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def borders(rows: DataFrame, shard_bytes: int = SHARD_BYTES, bars: int = BARS):
    """From rows (page_id, n): a function that adds `shard` to rows with page_id and h, and the number of shards.

    Ids stand in bars, and bars in finer bars; weights are cumulated over the bars in order, and a new
    shard begins wherever the sum passes another target. A fine bar that holds several targets (one id,
    or ids very near each other) gets as many shards, dealt by h. What comes to the driver is the first bar
    of each shard: SHARDS + 2 rows at most.
    """
    low, high, total = rows.agg(F.min("page_id"), F.max("page_id"), F.sum(F.col("n") + OVERHEAD)).first()
    target = max(shard_bytes, -(-int(total or 0) // SHARDS))
    low, high = (0, 0) if low is None else (int(low), int(high))
    wide = (high - low) // bars + 1
    fine = wide // bars + 1
    exact = "decimal(20,0)"
    off = F.col("page_id").cast(exact) - F.lit(low).cast(exact)
    # a number for each fine bar, in the order of ids; null ids come first
    bar = F.coalesce(F.floor(off / F.lit(wide)).cast("bigint"), F.lit(-1))
    code = bar * bars + F.coalesce(F.floor(F.pmod(off, F.lit(wide).cast(exact)) / F.lit(fine)).cast("bigint"), F.lit(0))
    w = rows.groupBy(code.alias("code")).agg(F.sum(F.col("n") + OVERHEAD).alias("w")).withColumn("bar", F.floor(F.col("code") / bars))
    # sums over the bars (bars + 1 rows in one window), then within each
    tops = w.groupBy("bar").agg(F.sum("w").alias("own")).select("bar", (F.sum("own").over(W.orderBy("bar")) - F.col("own")).alias("before"))
    upto = F.col("before") + F.sum("w").over(W.partitionBy("bar").orderBy("code"))
    at = cut(w.join(F.broadcast(tops), "bar").select("code", upto.alias("upto"), "w"))
    lot = F.floor((F.col("upto") - F.col("w")) / target).cast("bigint")
    parts = F.ceil(F.col("w") / target).cast("bigint")
    first = at.groupBy(lot.alias("lot")).agg(F.min("code").alias("code"), F.max(F.struct("code", parts.alias("parts"))).alias("last"))
    got = sorted((r["code"], r["last"]["code"], r["last"]["parts"]) for r in first.collect())
    starts, firsts, counts, shard = [], [], [], 0
    for code_, last, many in got:  # only a lot's last bar can pass the target by itself
        if many > 1:
            if last > code_:
                starts, firsts, counts, shard = [*starts, code_], [*firsts, shard], [*counts, 1], shard + 1
            starts, firsts, counts, shard = [*starts, last], [*firsts, shard], [*counts, many], shard + many
        else:
            starts, firsts, counts, shard = [*starts, code_], [*firsts, shard], [*counts, 1], shard + 1

    def place(df: DataFrame) -> DataFrame:
        at = _last_not_over(starts or [-bars], F.col("code"))
        pick = lambda xs: F.get(_constants(xs), F.col("at"))
        dealt = pick(firsts or [0]) + F.pmod(F.col("h"), pick(counts or [1]))
        return df.select("*", code.alias("code")).select("*", at.alias("at")).select("*", dealt.cast("int").alias("shard")).drop("code", "at")

    return place, max(1, shard)


def _constants(xs: list[int]) -> Column:
    """An array of constants as one literal, however many."""
    return F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")


def _last_not_over(xs: list[int], x: Column, fan: int = 64) -> Column:
    """Index of the last of the ascending xs that is not over x (0 if all are), found level by level."""
    levels = [xs]
    while len(levels[0]) > fan:
        levels.insert(0, levels[0][::fan])
    at = F.lit(0)
    for level in levels:
        block = F.slice(_constants(level), at * fan + 1, F.lit(fan))
        at = at * fan + F.greatest(F.size(F.filter(block, lambda y: y <= x)) - 1, F.lit(0))
    return at


def _writer(out: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(out)
        tag = f"{TaskContext.get().partitionId()}-{TaskContext.get().taskAttemptId()}"
        open_file, at, done, now, known, copy = None, None, [], None, None, 0
        fs.create_dir(f"{base}/_temporary", recursive=True)

        def start(shard: int, seq: int):
            nonlocal open_file, at
            name = f"{shard:06d}-{seq:05d}.warc.gz"
            temp = f"_temporary/{name}.{tag}"
            open_file = fs.open_output_stream(f"{base}/{temp}", compression=None)
            at = {"shard": shard, "seq": seq, "temp": temp, "name": name, "records": 0, "bytes": 0, "sha256": hashlib.sha256()}
            put(_record("warcinfo", "", [("Content-Type", "application/warc-fields"), ("WARC-Filename", name)], b"format: WARC File Format 1.1\r\n", name))

        def put(data: bytes):
            open_file.write(data)
            at["bytes"] += len(data)
            at["records"] += 1
            at["sha256"].update(data)

        def stop():
            open_file.close()
            done.append(at | {"sha256": at["sha256"].hexdigest()})

        for batch in batches:
            for r in batch.to_pylist():
                if at is None or r["shard"] != at["shard"]:
                    if at is not None:
                        stop()
                    start(r["shard"], 0)
                key = (r["page_id"], r["url"], r["digest"])
                if key != now:
                    now, known, copy = key, None, 0
                if r["step"] == 0:
                    known = (r["response"], r["response_url"]), r["revisit"]
                    continue
                if r["revisit"] is not None:  # many equal pages at once
                    known = (r["response"], r["response_url"]), r["revisit"]
                copy = r["copy"] or copy
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                for _ in range(r["copies"]):
                    if at["bytes"] >= roll:
                        stop()
                        start(at["shard"], at["seq"] + 1)
                    refers = known[0] if known is not None and (known[1] or copy) else None
                    put(page_record(r["page_id"], r["url"], b"" if refers else (r["html"] or b""), r["n"], digest, refers, copy))
                    copy += 1
        if at is not None:
            stop()
        yield pa.RecordBatch.from_pylist(done, pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("temp", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    return run


def write(pages: DataFrame, out: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 0, roll: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> None:
    """Writes the archive to the folder out, a URI that all executors reach; complete once _COMMITTED is there."""
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("bigint").alias("n"), F.sha1("html").alias("digest"))
    rows = rows.select("*", F.xxhash64(F.col("page_id").isNull(), "page_id", "url", "digest").alias("h"))
    narrow = cut(rows.drop("html"))
    # struct order puts null ids first, so the largest id wins; of equal ids, the greater address
    best = narrow.filter(F.col("n") >= min_revisit).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("best"), F.count("*").alias("many")).filter("many > 1")
    best = cut(best)
    is_best = F.col("best.page_id").eqNullSafe(F.col("page_id")) & (F.col("best.url") == F.col("url"))
    said = [F.col("best.page_id").alias("response"), F.col("best.url").alias("response_url"), F.when(F.col("best").isNotNull(), ~is_best).alias("revisit")]
    # equal pages in great number: one payload, and the rest by count
    hot = heavy_keys(narrow.groupBy("h").agg(F.count("*").alias("many")), "h", "many")
    many = F.broadcast(spark.createDataFrame([(h,) for h in hot], "h bigint"))
    single = (lambda df: df.join(many, "h", "left_anti")) if hot else (lambda df: df)
    # what is told of rows with copies goes to their shard without the payload, ahead of the row itself
    told = lookup(single(narrow), best, "digest", "many").filter("best is not null")
    told = told.select("page_id", "url", "n", "digest", "h", *said, F.lit(None).cast("binary").alias("html"), F.lit(0).alias("step"), F.lit(0).alias("copies"), F.lit(0).cast("bigint").alias("copy"))
    none = [F.lit(None).cast("bigint").alias("response"), F.lit(None).cast("string").alias("response_url"), F.lit(None).cast("boolean").alias("revisit")]
    sent = single(rows).select("page_id", "url", "n", "digest", "h", *none, "html", F.lit(1).alias("step"), F.lit(1).alias("copies"), F.lit(0).cast("bigint").alias("copy")).unionByName(told)
    if hot:
        equal = rows.join(many, "h", "left_semi").groupBy("page_id", "url", "n", "digest", "h").agg(F.count("*").alias("all"), F.first("html").alias("html"))
        equal = equal.join(best, "digest", "left").select("page_id", "url", "n", "digest", "h", *said, "html", "all")
        equal = equal.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("all") - 1, F.lit(TOGETHER).cast("bigint"))).alias("copy"))
        # each lot goes where its own hash says, the first with the payload; where none may be a revisit, all
        payload = F.when((F.col("copy") == 0) | F.col("revisit").isNull(), F.col("html"))
        lots = equal.select("page_id", "url", "n", "digest", F.xxhash64("h", "copy").alias("h"), "response", "response_url", "revisit", payload.alias("html"), F.lit(1).alias("step"), F.least(F.col("all") - F.col("copy"), F.lit(TOGETHER)).cast("int").alias("copies"), "copy")
        sent = sent.unionByName(lots)
    place, count = borders(narrow.select("page_id", "n"), shard_bytes)
    order = ("shard", F.col("page_id").asc_nulls_first(), "digest", "url", "step", "copy")
    sent = place(sent).repartitionById(count, F.col("shard")).sortWithinPartitions(*order)
    by_batches(sent, _writer(out, roll), FILES).write.mode("overwrite").parquet(f"{out}/_manifest")
    commit(spark, out)


def commit(spark: SparkSession, out: str) -> None:
    """Renames the files that the manifest names and marks the archive as complete; may be run again."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(out)
        for batch in batches:
            for r in batch.to_pylist():
                there = fs.get_file_info(f"{base}/{r['name']}")
                if there.type == pafs.FileType.NotFound or there.size != r["bytes"] or fs.get_file_info(f"{base}/{r['temp']}").type != pafs.FileType.NotFound:
                    fs.move(f"{base}/{r['temp']}", f"{base}/{r['name']}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["records", "bytes"])

    files = spark.read.schema(FILES).parquet(f"{out}/_manifest")
    n, records, size = by_batches(files.select("records", "bytes", "name", "temp"), move, "records bigint, bytes bigint").agg(F.count("*"), F.sum("records"), F.sum("bytes")).first()
    fs, base = filesystem(out)
    if fs.get_file_info(f"{base}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{base}/_temporary")
    with fs.open_output_stream(f"{base}/_COMMITTED") as f:
        f.write(json.dumps({"files": n, "records": records or 0, "bytes": size or 0}).encode())


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked one by one."""
    data, unpack, out = b"", None, []
    while True:
        if not data:
            data = stream.read(step)
            if not data:
                break
        if unpack is None:
            unpack, out = zlib.decompressobj(31), []
        out.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(out)
            unpack = None
    if unpack is not None:
        raise ValueError("the last record is cut short")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != CRLF + CRLF:
        raise ValueError(f"not a whole WARC record: {lines[0]}")
    block = rest[:size]
    if fields["WARC-Block-Digest"] != "sha1:" + base32_sha1(block):
        raise ValueError(f"block digest differs: {fields['WARC-Record-ID']}")
    return fields, block


READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read(spark: SparkSession, out: str, *, payloads: bool = False) -> DataFrame:
    """The archive's page records, digests checked. With payloads: html of responses (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(out)
        number = lambda x: None if x in (None, "null") else int(x)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), *([("html", pa.string())] if payloads else [])])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in members(stream):
                        fields, block = parse(record)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(CRLF + CRLF)[2]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        whole = fields["WARC-Type"] == "response"
                        if whole and (base32_sha1(payload) != digest or len(payload) != int(fields["X-Payload-Length"])):
                            raise ValueError(f"payload digest differs: {fields['WARC-Record-ID']}")
                        rows.append((number(fields["X-Page-ID"]), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, fields["WARC-Type"], number(fields.get("X-Refers-To-Page-ID")), *([payload.decode() if whole else None] if payloads else [])))
                        held += len(payload)
                        if len(rows) >= 5000 or held > 8 << 20 and payloads:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.schema(FILES).parquet(f"{out}/_manifest").select("name")
    n = files.count()
    return by_batches(files.repartition(max(1, min(n, 20_000))), run, READ + (", html string" if payloads else ""))


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the pages to a new archive in the shared folder and reads it back."""
    out = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, out)
    return read(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
