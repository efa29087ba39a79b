"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multipliers of the rolling hashes (odd, so that they can be inverted modulo 2^64).
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one of our own, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or _own_folder()


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it back: it cuts the lineage and outlives executors.

    The table goes with dropped(), or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    removed_at_exit(spark, path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def dropped(*tables: DataFrame) -> None:
    """Remove tables that materialize() returned and that nothing reads any more."""
    for table in tables:
        folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def dealt_apart(many: DataFrame, few: DataFrame, key: str | list[str], by: list[str], salts: int = 16) -> DataFrame:
    """Left join of many rows to at most one row a key, where a key may hold a large share of the rows.

    The rows of a key are dealt to `salts` tasks by a hash of the columns `by` and by the task that they come from.
    """
    keys = [key] if isinstance(key, str) else key
    salt = F.pmod(F.xxhash64(*by) + F.spark_partition_id(), F.lit(salts)).cast("int")
    copies = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.withColumn("__salt", salt).join(copies, [*keys, "__salt"], "left").drop("__salt")


#: Rows of one key that a task meets, before they are dealt to several.
HUB = 50_000


def dealt_by_count(many: DataFrame, few: DataFrame, key: str | list[str], by: list[str], most: int = HUB) -> DataFrame:
    """Join of many rows to the one row of their key in few, whose column n says how many rows the key has; keys with more than `most` are dealt apart.

    Only those keys are copied and broadcast: there are `most` times fewer of them than rows. The others are joined as they are.
    """
    keys = [key] if isinstance(key, str) else key
    parts = F.ceil(F.col("n") / most).cast("int")
    hubs = F.broadcast(few.where(F.col("n") > most).select(*keys, parts.alias("__parts")))
    salt = F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*by) + F.spark_partition_id(), F.col("__parts").cast("long"))).cast("int")
    copies = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))).drop("n")
    return many.join(hubs, keys, "left").withColumn("__salt", salt).drop("__parts").join(copies, [*keys, "__salt"]).drop("__salt")


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system of a path remove it when the driver's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def give_back_memory() -> None:
    """Let what this process has freed go back to the system: Python workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse, kept per process and grown by doubling."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        kept = powers(base, size), powers(np.uint64(pow(int(base), -1, 1 << 64)), size)
        _POWERS[int(base)] = kept
    return kept


class RollingHash:
    """Hashes of any substring of a sequence of 64-bit symbols, from prefix sums."""

    def __init__(self, symbols: np.ndarray, base: np.uint64 = BASE):
        forward, self.inverse = _powers_of(base, len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * forward[: len(symbols)], out=self.prefix[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.prefix[stop] - self.prefix[start]) * self.inverse[start])


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def split_batches(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Slices of a batch whose texts together take about limit bytes (a longer row stands alone)."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
