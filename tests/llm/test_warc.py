"""The archive's round trip: rows, digests, revisits, rolling, determinism."""

import base64
import gzip
import hashlib
import os
import random

import pytest

from quire.llm import warc

SCHEMA = "page_id long, url string, html string, shard string"


def pages():
    pick = random.Random(2)
    text = lambda n: "".join(pick.choice("abcé <>\r\n") for _ in range(n))
    rows = [(i, f"http://x/{i}", text(pick.choice([0, 1, 50, 4000])), "x") for i in range(60)]
    rows += [(100 + i, "http://same/", "the same page", None) for i in range(30)]
    rows += [(7, "http://x/7", "again", "x"), (7, "http://x/7", "again", "x"), (7, "http://y/7", "again", "x")]
    rows += [(None, None, None, None), (None, "http://a b\n", "", "x"), (500, None, None, "x"), (10**15, "http://far/", text(300_000), "y"), (-5, "u", "WARC/1.1\r\n\r\n", "z")]
    return rows


def wanted(rows):
    best = {}
    for p, u, h, _ in rows:
        best[h or ""] = max(best.get(h or "", (False, 0, "")), (p is not None, p or 0, u or ""))
    used, out = set(), []
    for p, u, h, _ in sorted(rows, key=repr):
        data = (h or "").encode()
        first = best[h or ""] == (p is not None, p or 0, u or "") and (h or "") not in used
        if first:
            used.add(h or "")
        ref = best[h or ""]
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first or not ref[0] else ref[1]))
    return sorted(map(repr, out))


def told(df):
    return sorted(repr(tuple(r)) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def records(folder):
    out = []
    for x in sorted(os.listdir(folder)):
        if x.endswith(".gz"):
            with open(folder / x, "rb") as f:
                out += [warc.parse(r)[0] for r in warc.members(f)]
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 30, 3000])
def test_round_trip(spark, tmp_path, shard_bytes):
    rows = pages()
    out = f"file://{tmp_path}/a"
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(5), out, shard_bytes=shard_bytes, roll=2000)
    assert told(warc.read(spark, out)) == wanted(rows)
    texts = {r.payload_digest: r.html for r in warc.read(spark, out, payloads=True).collect() if r.record_type == "response"}
    for _, _, h, _ in rows:
        assert texts[warc.base32_sha1((h or "").encode())] == (h or "")
    assert os.path.exists(tmp_path / "a/_COMMITTED") and not os.path.exists(tmp_path / "a/_temporary")
    warc.commit(spark, out)  # once more does no harm
    assert told(warc.read(spark, out)) == wanted(rows)


def test_same_bytes_whatever_the_partitions(spark, tmp_path):
    rows = pages()
    for name, n in (("a", 1), ("b", 7)):
        pick = random.Random(n)
        pick.shuffle(rows)
        warc.write(spark.createDataFrame(rows, SCHEMA).repartition(n), f"file://{tmp_path}/{name}", shard_bytes=20_000, roll=3000)
    names = sorted(x for x in os.listdir(tmp_path / "a") if x.endswith(".gz"))
    assert len(names) > 3 and names == sorted(x for x in os.listdir(tmp_path / "b") if x.endswith(".gz"))
    for x in names:
        assert (tmp_path / "a" / x).read_bytes() == (tmp_path / "b" / x).read_bytes()
        assert gzip.decompress((tmp_path / "a" / x).read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_least_bytes_for_revisits(spark, tmp_path):
    rows = [(1, "a", "xx", ""), (2, "b", "xx", ""), (3, "c", "long enough", ""), (4, "d", "long enough", "")]
    warc.write(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/m", min_revisit=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(spark, f"file://{tmp_path}/m").collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_null_and_empty_addresses_are_one(spark, tmp_path):
    rows = [(1, None, "same", ""), (1, "", "same", ""), (1, None, "same", "")]
    out = f"file://{tmp_path}/n"
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), out, shard_bytes=700)
    assert sorted(r.record_type for r in warc.read(spark, out).collect()) == ["response", "revisit", "revisit"]


def test_ids_are_unique_and_revisits_can_be_followed(spark, tmp_path):
    warc.write(spark.createDataFrame(pages() + pages()[:20], SCHEMA), f"file://{tmp_path}/u", shard_bytes=5000, roll=2000)
    found = records(tmp_path / "u")
    ids = [f["WARC-Record-ID"] for f in found]
    assert len(ids) == len(set(ids))
    by_id = {f["WARC-Record-ID"]: f for f in found}
    revisits = [f for f in found if f["WARC-Type"] == "revisit"]
    assert len(revisits) > 40
    for f in revisits:
        other = by_id[f["WARC-Refers-To"]]
        assert other["WARC-Type"] == "response" and other["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        assert (other["WARC-Target-URI"], other["WARC-Date"], other["X-Page-ID"]) == (f["WARC-Refers-To-Target-URI"], f["WARC-Refers-To-Date"], f["X-Refers-To-Page-ID"])


def test_equal_pages_in_great_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "TOGETHER", 100)
    rows = [(5, "http://x/5", "hot page", "s")] * 730 + [(9, "http://x/9", "hot page", "s")] * 3 + [(i, f"u{i}", f"page {i}", None) for i in range(200)]
    out = f"file://{tmp_path}/h"
    for least, kinds in ((0, {"response": 201, "revisit": 732}), (100, {"response": 933})):
        warc.write(spark.createDataFrame(rows, SCHEMA).repartition(7), out + str(least), shard_bytes=20_000, min_revisit=least)
        got = warc.read(spark, out + str(least)).collect()
        assert {k: sum(r.record_type == k for r in got) for k in kinds} == kinds and len(got) == len(rows)
        assert {r.refers_to for r in got if r.record_type == "revisit"} <= {9}
        ids = [f["WARC-Record-ID"] for f in records(tmp_path / f"h{least}")]
        assert len(ids) == len(set(ids))
        shards = {x.split("-")[0] for x in os.listdir(tmp_path / f"h{least}") if x.endswith(".gz")}
        assert len(shards) > 3


@pytest.mark.parametrize("ids", [range(3000), [x**2 for x in range(3000)], [1] * 500 + list(range(10**9, 10**9 + 500)), [10**18, -(10**18), 0, None]])
def test_borders_are_few_and_in_order(spark, monkeypatch, ids):
    rows = spark.createDataFrame([(i, 1000, k) for k, i in enumerate(ids)], "page_id long, n long, h long")
    gathered = []
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: gathered.append(collect(df)) or gathered[-1])
    place, count = warc.borders(rows.select("page_id", "n"), shard_bytes=20_000, bars=16)
    total = len(ids) * 1600
    assert sum(map(len, gathered)) <= total // 20_000 + 2 and count <= 3 * (total // 20_000 + 1)
    at = sorted((r["page_id"] is not None, r["page_id"] or 0, r["shard"]) for r in place(rows).collect())
    assert {s for _, _, s in at} <= set(range(count))
    if isinstance(ids, range):  # no bar is dense: shards follow ids
        assert [s for _, _, s in at] == sorted(s for _, _, s in at)
        assert max(sum(s == k for _, _, s in at) for k in range(count)) * 1600 <= 4 * 20_000 * 16


def test_last_not_over(spark):
    xs = list(range(0, 30_000, 3))
    got = spark.range(-5, 30_010, 7).select("id", warc._last_not_over(xs, warc.F.col("id")).alias("at")).collect()
    assert all(r["at"] == min(max(r["id"] // 3, 0), len(xs) - 1) for r in got)


def test_damage_is_found(spark, tmp_path):
    record = warc.page_record(1, "u", b"abc", 3, warc.base32_sha1(b"abc"), None)
    raw = gzip.decompress(record)
    fields, block = warc.parse(raw)
    assert fields["WARC-Type"] == "response" and block.endswith(b"\r\n\r\nabc")
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))


def test_empty(spark, tmp_path):
    warc.write(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/e")
    assert warc.read(spark, f"file://{tmp_path}/e").count() == 0
