"""What the corpus operators share: the shared folder, written tables and word hashing."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multipliers of the splitmix64 finalizer.
_MIX1, _MIX2, _GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15

#: The contract's word: a run of characters that are neither a space nor U+0009 to U+000D.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. A session of one machine that names none, as in tests, gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='parlance-')}")
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is written, not only when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Tables:
    """Tables that a run writes to the shared folder: they cut lineage, survive lost executors, and go when no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.written: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        with shuffles_freed(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if found := self.written.pop(id(t), None):
                delete_path(self.spark, found[1])


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on a Python worker of the session gets at most so many rows at once: whole texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def spread(spark: SparkSession, times: int = 1) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * times)


def release() -> None:
    """Gives memory that is no longer used back to the system: a Python worker outlives its tasks, and both allocators keep what they had at most."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Name under which a worker keeps what its next task of the same operator can use.
KEPT = "_parlance_kept"


def tidy(make, keep: bool = False):
    """A generator of batches that releases memory when it ends, and unless it is to ``keep`` it what the worker kept for another operator when it begins."""

    @wraps(make)
    def run(*args, **options):
        if not keep:
            sys.modules.pop(KEPT, None)
        try:
            yield from make(*args, **options)
        finally:
            release()

    return run


class WordHashes(dict):
    """64-bit hashes of words as bytes; keeps those of the first ``room`` words it meets."""

    def __init__(self, room: int = 100_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.room:
            self[word] = h
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def fold(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes."""
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= np.uint64(_GOLDEN)
        out += hashes[i : i + n]
    return mix64(out + np.uint64(k))


def shingles(raw: bytes | None, k: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text; with fewer words the whole sequence is one shingle."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(fold(word_hashes(words, cache), min(k, len(words))))


def column_bytes(column) -> list[bytes | None]:
    """A batch's string column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Edges that one task contracts by itself, at most: 16 bytes each.
LAST_EDGES = 1 << 14


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) to (u, to): the least id that each is connected with."""
    to: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := to.setdefault(x, x)) != x:
            to[x] = to[y]
            x = y
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            to[max(a, b)] = min(a, b)
    ids = list(to)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], ["u", "to"])


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """Connected components of the graph of ``edges`` (a, b): one row (id, component) for each id in an edge; component is the smallest id.

    Randomised contraction: in each round every vertex merges into the neighbour (or itself) of least random
    priority; edges are rewritten between the merged vertices. The count of vertices falls by a constant factor
    a round, also along chains, and a hub's edges collapse at once. Each round is a written table. ``LAST_EDGES`` edges and fewer are
    contracted by one task at once.
    """
    e = tables.write(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    label = e.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id"))
    label, turn = tables.write(label, "cc-labels"), 0
    while (left := e.count()) > 0:
        turn += 1
        if left <= LAST_EDGES:
            merged = e.coalesce(1).mapInArrow(contracted, "u bigint, to bigint")
        else:
            both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
            rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), c.alias("id"))  # noqa: B023, E731
            least = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("least"))
            merged = least.select("u", F.least("least", rank(F.col("u")))["id"].alias("to"))
        to = tables.write(merged, "cc-merge")
        at = lambda c: to.select(F.col("u").alias(c), F.col("to").alias(f"{c}_to"))  # noqa: B023, E731
        moved = label.withColumnRenamed("component", "c").join(at("c"), "c", "left").select("id", F.coalesce("c_to", "c").alias("component"))
        moved = tables.write(moved, "cc-labels")
        if left <= LAST_EDGES:
            tables.drop(label, to)
            label = moved
            break
        kept = e.join(at("a"), "a").join(at("b"), "b").where("a_to <> b_to").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        kept = tables.write(kept, "cc-edges")
        tables.drop(e, label, to)
        e, label = kept, moved
    tables.drop(e)
    least = label.groupBy("component").agg(F.min("id").alias("least"))
    out = tables.write(label.join(least, "component").select("id", F.col("least").alias("component")), "cc-components")
    tables.drop(label)
    return out
