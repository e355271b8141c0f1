"""Helpers shared by the corpus operators: shared scratch tables, words, hashing."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Texts are worked on in runs of about this many bytes, so memory does not follow the batch.
RUN_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where the session names none, a
    local session gets a folder of its own; a cluster must be given one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quire-llm-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def released(task: Callable) -> Callable:
    """A task's function that at its end hands back the memory it used: Python workers wait for
    other tasks, and what they keep is missing to these."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim is not None:
                trim(0)

    return run


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quire-llm/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def batch_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs run inside hand Python so many rows at a time; rows that carry sets or long
    texts would else make batches of a hundred megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside leave no shuffle files, which else stay until the driver collects what refers to them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: later jobs
    start there, also when an executor is lost. ``rows``: see ``batch_rows``."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with batch_rows(spark, rows):
        df.write.parquet(path)
    return spark.read.schema(StructType([f for f in df.schema])).parquet(path)


def dealt(df: DataFrame, column: str, label: str, rows: int | None = None) -> DataFrame:
    """As ``written``, in a bucket of ``column`` for each shuffle partition: joins on it leave these rows where they are,
    which saves a shuffle of all of them. The catalogue has the table only until it is known here."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    name = f"spark_catalog.default.quire_{path.rsplit('/', 1)[1].replace('-', '_')}"
    writer = df.write.format("parquet").option("parquet.block.size", str(16 << 20)).option("path", path)
    with batch_rows(spark, rows):
        writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the table has a path of its own
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_values(column: pa.Array) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null is the empty string."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def runs(texts: list[bytes], most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``most`` bytes; a longer text is a range of its own."""
    return runs_of([len(t) for t in texts], most)


def runs_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def odd_constants(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * GOLD
    return mix64(x) | np.uint64(1)


def windows(hashes: np.ndarray, n: int, multipliers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` neighbouring word hashes."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:m] * multipliers[0]
    for j in range(1, n):
        out += hashes[j : j + m] * multipliers[j]
    return mix64(out)


def bit_filter(df: DataFrame, hashed: Column, log2_bits: int = 24) -> np.ndarray:
    """A bitmap of hash values: 2**log2_bits bits whatever the input, so it may be sent to
    all tasks. It lets strangers through; an exact join follows."""
    rows = (
        df.select(hashed.bitwiseAND(F.lit((1 << log2_bits) - 1)).alias("h"))
        .groupBy(F.shiftright("h", 5).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 32 AS int))")).alias("b"))
        .toPandas()
    )
    bits = np.zeros(1 << (log2_bits - 5), np.uint32)
    bits[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).astype(np.uint32)
    return bits


def in_filter(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of the hash values may be in the bitmap."""
    h = hashed.astype(np.int64) & np.int64(len(bits) * 32 - 1)
    return (bits[h >> 5] >> (h & 31).astype(np.uint32)) & np.uint32(1) == 1


def put_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes ``data`` to the shared folder and hands it to all executors as a local file;
    returns the name to ask ``SparkFiles`` for."""
    path = fresh_path(spark, name)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, False)
    try:
        for at in range(0, len(data), 4 << 20):
            out.write(bytearray(data[at : at + (4 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]
