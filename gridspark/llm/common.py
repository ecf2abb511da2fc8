"""What the operators of this subpackage share: the shared folder, lineage cuts, Arrow batches, bounded caches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Entries a worker's cache holds before it starts afresh, and the longest key that outlives its slice: both bound its bytes.
CACHE_ENTRIES, CACHE_KEY = 200_000, 64
#: Bytes of text that an operator holds as Python objects at a time (one longer text is held alone).
SLICE_BYTES = 4 << 20
#: Bytes of an Arrow batch between Spark and a worker (one longer row travels alone).
BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own where it is unset."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset; executors need a folder that all of them share")
        path = tempfile.mkdtemp(prefix="gridspark-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """df, written once to the shared folder and read from there: later jobs do not run its lineage again."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the folders of cut tables that nothing reads any more.  Those that a lazy result reads stay in the shared folder."""
    for t in tables:
        remove(t.sparkSession, t.cut_path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of this session from now on hold at most BATCH_BYTES (a row more)."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))


def slices(batches: Iterable[pa.RecordBatch], *texts: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``limit`` bytes of the columns ``texts``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = sum(pc.fill_null(pc.binary_length(batch.column(t)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
        at = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text") -> DataFrame:
    """mapInArrow of a function of one bounded slice."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            out = fn(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


_resident: dict[Hashable, object] = {}


def resident[T](key: Hashable, make: Callable[[], T]) -> T:
    """The worker's one long-lived object (a model with its cache): another key frees it, so that operators that follow each other in a reused worker don't add up."""
    if key not in _resident:
        if _resident:
            _resident.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim()
        _resident[key] = make()
    return _resident[key]


def trim() -> None:
    """Returns freed memory to the system where the C library can."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(known: dict, new: Iterable[str], entries: int) -> dict:
    """A cache after a slice: what was new and is longer than CACHE_KEY goes, and a full cache starts afresh."""
    for w in new:
        if len(w) > CACHE_KEY:
            known.pop(w, None)
    return known if len(known) <= entries else {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
