"""Helpers shared by the operators: shared-folder tables, byte-level text
functions for Arrow batches, and connected components over an edge table."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import ensure_checkpoint_dir

#: A-Z to a-z, every other byte unchanged (UTF-8 stays valid).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder (`spark.checkpoint.dir`),
    deleted when the session's file system closes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: the
    lineage ends there, so a lost executor never replays what lies above."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of one Arrow batch; with rows of any size, it bounds a worker's memory.
BATCH_BYTES = 4 << 20


def hand_back() -> None:
    """Return freed memory to the system, as a worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """`df.mapInArrow(fn, schema)` over batches of bounded bytes; a task hands back
    the memory it no longer uses, as its worker lives on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        hand_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column(batch, name).cast(pa.binary()).to_pylist()


def rows_in_pieces(batch: pa.RecordBatch, size: int, n_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch: at most `size` rows each and about `n_bytes` of data,
    so that work arrays stay small whatever the batch holds."""
    step = max(1, min(size, int(batch.num_rows * n_bytes / max(batch.nbytes, 1))))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def held_out(doc_id: str, mod: int, rest: int):
    """True where crc32 of the id's decimal text leaves `rest` modulo `mod`;
    false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI, on whatever store it is."""
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


#: Largest bitmap sent to the tasks, in 64-bit words (16 MB).
BITMAP_WORDS = 1 << 21


class Bitmap:
    """A set of hashes `h` as a bitmap of bounded size: no hash of the set is
    missed, and the larger the set, the more others pass."""

    def __init__(self, hashes: DataFrame, n: int):
        self.bits = min(BITMAP_WORDS * 64, max(1 << 16, 1 << (16 * max(1, n)).bit_length()))
        bit = F.pmod("h", F.lit(self.bits))
        words = hashes.select((bit / 64).cast("long").alias("w"), F.expr("shiftleft(1L, cast(pmod(h, 64) as int))").alias("b"))
        rows = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)

    def among(self, h: np.ndarray) -> np.ndarray:
        """Whether 64-bit hashes pass."""
        at = h & np.uint64(self.bits - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def holds(self, h: Column) -> Column:
        """Whether hashes pass; only they go to Python."""
        @F.pandas_udf("boolean")
        def test(s: pd.Series) -> pd.Series:
            return pd.Series(self.among(s.to_numpy(np.int64).view(np.uint64)))

        return test(h)


def apart(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` in two: all rows whose doc_id is one of `ids(doc_id)`, with perhaps
    some more, and others.  What follows has to join only the first."""
    found = Bitmap(ids.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h")), ids.count())
    hit = found.holds(F.xxhash64(F.col("doc_id").cast("long")))
    return docs.where(hit), docs.where(~hit)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected graph `edges(a, b)`: one row
    (node, root) per node that is not its component's smallest node, root being
    that smallest node.  Alternates the large-star and small-star steps
    (Kiveris et al., 2014); each round is written to the shared folder, rounds
    stop when the edge set no longer changes.  A hub's edges are spread by AQE's
    skew join; the grouped minimum has a map-side partial aggregate."""
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = cut(small.union(least).distinct(), "cc")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.toDF("node", "root")


def _mark(e: DataFrame) -> tuple:
    """Count and order-free hash of an edge set."""
    h = F.xxhash64("a", "b")
    r = e.agg(F.count("*"), F.coalesce(F.sum(h % 1000000007), F.lit(0)), F.coalesce(F.sum(F.shiftrightunsigned(h, 34)), F.lit(0))).first()
    return tuple(r)
