"""Helpers that the corpus operators share."""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder if all runs in this process, as in tests; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="quire-shared-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, materialised in the shared folder; lineage ends here and no executor's loss undoes it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Bytes that go to Python at once.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_batches(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow in batches of BATCH_BYTES or a single row: Python's and Arrow's memory stay small beside the heap.

    Spark reads the bound from the session when the plan runs; a lower one of the user's stays.
    """
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_CONF, None) or 1 << 62) > BATCH_BYTES:
        conf.set(BATCH_CONF, BATCH_BYTES)
    names = df.columns
    if not any(c in n for n in names for c in ".`"):
        return df.mapInArrow(run, schema)

    def named(batches):  # Spark can't send such names
        return run(pa.RecordBatch.from_arrays(b.columns, names) for b in batches)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(named, schema)


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that df doesn't have, however it is written."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """df's columns, whatever is in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_mark(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row, nulls told from each other's places; maps by their JSON."""
    parts = []
    for c, field in zip(columns_of(df), df.schema, strict=True):
        nested = field.dataType.simpleString()
        value = F.to_json(F.struct(c)) if "map<" in nested or "variant" in nested else c
        parts += [value, c.isNull()]
    return F.xxhash64(*parts)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column's values as UTF-8, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def crc_bucket(column: str, modulus: int):
    """crc32 of an integer id's decimal text, modulo modulus; null ids count as the text 'null'."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null"))), F.lit(modulus)).cast("int")


def slices(values: list[bytes | None], limit: int = 4 << 20):
    """Index ranges of values with about limit bytes each; a longer value stands alone."""
    start, size = 0, 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(values):
        yield start, len(values)


def sha_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


#: A key with over a SHARE-th of all rows, or more than a task's share of them, is hot; keys at most that are broadcast.
SHARE, SHARE_MOST = 500, 100_000


def share_of(spark: SparkSession) -> int:
    """As many keys as there are shuffle partitions may be hot: one with more rows than a partition's share must not meet in one."""
    return max(SHARE, min(int(spark.conf.get("spark.sql.shuffle.partitions")), SHARE_MOST))


def heavy_keys(sizes: DataFrame, key: str, count: str, share: int | None = None) -> list:
    """Keys with at least a share-th of all rows: share of them at most, whatever the data, so they may be gathered and broadcast."""
    share = share or share_of(sizes.sparkSession)
    total = sizes.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    return [r[0] for r in sizes.filter((F.col(count) * share >= F.lit(total)) & (F.col(count) > SPREAD_FROM) & F.col(key).isNotNull()).select(key).collect()]


#: Rows of one key that a task may well hold, however small the table.
SPREAD_FROM = 200


def lookup(rows: DataFrame, small: DataFrame, key: str, count: str, share: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """rows left-joined to small (one row per key at most, count is how many rows have it), hot keys by broadcast.

    A key with over 1/share of all rows (share_of the session) never meets in one task: those keys, share at most, are
    broadcast; the others go through an ordinary shuffled join. sizes: (key, count) where that is
    cheaper to read than small.
    """
    hot = heavy_keys(small if sizes is None else sizes, key, count, share)
    if not hot:
        return rows.join(small, key, "left")
    keys = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], small.select(key).schema))
    rest = rows.join(keys, key, "left_anti").join(small, key, "left")
    return rows.join(keys, key, "left_semi").join(F.broadcast(small.join(keys, key, "left_semi")), key, "left").unionByName(rest)


def once_each(marked: DataFrame, chosen: DataFrame, mark: str, count: str) -> DataFrame:
    """One row for each mark in chosen (one row per mark, count is how many rows have it), with chosen's columns.

    Rows of one mark are equal, so any will do. A mark of very many rows is thinned out where the rows are, before anything is sent.
    """
    hot = heavy_keys(chosen, mark, count)
    if not hot:
        return marked.join(chosen, mark).dropDuplicates([mark])
    keys = F.broadcast(marked.sparkSession.createDataFrame([(k,) for k in hot], chosen.select(mark).schema))
    rest = marked.join(keys, mark, "left_anti").join(chosen, mark).dropDuplicates([mark])
    thick = marked.join(keys, mark, "left_semi").dropDuplicates([mark]).join(F.broadcast(chosen.join(keys, mark, "left_semi")), mark)
    return rest.unionByName(thick)
