"""Helpers shared by the training-data operators.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D in the UTF-8 text:
``bytes.split()`` on the Python side, ``WORD`` on the JVM side. Hashes are
xxh3 values of whole words, combined per window, so they are the same in every
executor and after every retry.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A hash is a heavy hitter from this many rows on; at most HEAVY_KEYS are told apart.
HEAVY_ROWS = 2_000
HEAVY_KEYS = 512
HEAVY_TRACKED = 10_000
SALTS = 64

# The smallest long stands for a null id inside an operator.
NULL_ID = -(1 << 63)
BROADCAST_IDS = 500_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (a temporary one only where that is unset and the master is local)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cartwheel-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work done once, lineage cut."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` words; the two lanes are independent enough to make 128 bits."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if lane:
        words = (words ^ (words >> np.uint64(31))) * _MIX[0]
        words ^= words >> np.uint64(29)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _MIX[lane] + words[k : k + n]
    out ^= out >> np.uint64(32)
    out *= _MIX[1 - lane]
    return out ^ (out >> np.uint64(29))


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one value at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py()


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, most_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Rows to Arrow batches bounded in rows and (for binary and text values) in bytes."""
    columns: list[list] = [[] for _ in schema]
    held = 0
    for row in rows:
        for to, value in zip(columns, row, strict=True):
            to.append(value)
            if isinstance(value, (bytes, str)):
                held += len(value)
        if len(columns[0]) >= size or held >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            columns, held = [[] for _ in schema], 0
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def heavy_keys(df: DataFrame, key: str) -> list[int]:
    """At most HEAVY_KEYS values of the long column ``key`` that hold many rows.

    One pass over all rows with a mergeable frequent-items sketch per task. The
    list only chooses which of two exact ways a key takes, never a result.
    """
    top = df.select(F.expr(f"approx_top_k({key}, {HEAVY_KEYS}, {HEAVY_TRACKED})").alias("top")).first()["top"] or []
    return [x["item"] for x in top if x["item"] is not None and x["count"] >= HEAVY_ROWS]


def ranked_id(col: Column) -> Column:
    """A long id with null as the smallest value (``plain_id`` undoes it)."""
    return F.coalesce(col.cast("long"), F.lit(NULL_ID))


def plain_id(col: Column) -> Column:
    return F.when(col != NULL_ID, col)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(docs: DataFrame, id_col: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose id is (``left_semi``) or isn't (``left_anti``) in the one-column table ``ids`` of distinct ids.

    The ids are broadcast when a count shows at most BROADCAST_IDS of them (8 bytes each); beyond that Spark shuffles.
    """
    ids = ids.toDF("_only")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_only"]), how)


def salted(df: DataFrame, key: str, spread: str, heavy: list[int]) -> DataFrame:
    """``df`` with ``salt``: 0, but for rows of a heavy key a number below SALTS by the hash of ``spread``."""
    if not heavy:
        return df.withColumn("salt", F.lit(0))
    return df.withColumn("salt", F.when(F.col(key).isin(heavy), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0))


def after_first_holder(df: DataFrame, keys: list[str], holder: str, heavy: list[int], ranged: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``holder`` is above the smallest one with equal ``keys``.

    ``keys[0]`` is a long hash, ``holder`` has no nulls. The rows go through one
    partitioning on the keys (by range, or by hash where that saves a costly
    input from being run for its bounds first) with a sort by holder inside, from
    which the first holder streams. The rows of a heavy key are dealt over SALTS
    runs, each of which finds its own first; what is at most one holder of each
    run is then settled among themselves.
    """
    runs = salted(df, keys[0], holder, heavy)
    if ranged:
        runs = runs.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "salt")
    ordered = Window.partitionBy(*keys, "salt").orderBy(holder).rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("_first", F.first(holder).over(ordered))
    later = F.col(holder) > F.col("_first")
    if not heavy:
        return runs.filter(later).select(*df.columns)
    runs = stored(runs.filter(later | F.col(keys[0]).isin(heavy)), "runs")
    firsts = runs.filter(~later)
    least = firsts.groupBy(*keys).agg(F.min(holder).alias("_least"))
    beaten = firsts.join(least, keys).filter(F.col(holder) > F.col("_least"))
    return runs.filter(later).select(*df.columns).unionByName(beaten.select(*df.columns))
