"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import pickle
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows of an Arrow batch, unless the session sets its own number.  Spark's 10,000
#: texts of some KB take tens of MB in a task's JVM and again in its worker.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of a batch that go to a worker, unless the session sets its own number: rows of
#: packed values are many times longer than texts.  Spark's 64 MB are held by the JVM and by
#: the worker, there twice as they become Python's bytes.
BATCH_MB = 4
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship() -> None:
    """Pickle this subpackage's worker code with the task, so executors need
    only numpy, pyarrow and the tokenizer libraries installed, and bound the
    rows and bytes of an Arrow batch where the session has Spark's default."""
    cloudpickle.register_pickle_by_value(sys.modules["tessera.llm"])
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    if spark is not None and spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, f"{BATCH_MB}m")


def send(sc, value):
    """Broadcast an object of this subpackage's classes: as bytes that hold the
    classes too, since a broadcast alone names them by module."""
    return sc.broadcast(cloudpickle.dumps(value))


def received(bc):
    """The object behind :func:`send`; rebuilt once per call, so once per task."""
    return pickle.loads(bc.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and return a scan of it.

    Cuts the lineage: a lost executor costs a re-read of a table that all
    executors see, never a recomputation.
    """
    spark = df.sparkSession
    path, schema = scratch_path(spark, f"llm-{name}"), df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the cleaner drop the shuffle files of plans nobody holds any more,
    now instead of at the driver's next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (the contract's case folding; locale-free)."""
    return F.translate(col, _UPPER, _UPPER.lower())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered; emptied when it holds ``limit``
    words so a worker's memory stays bounded on any vocabulary."""

    def __init__(self, limit: int = 1 << 16):
        super().__init__()
        import xxhash
        self._h, self._limit = xxhash.xxh3_64_intdigest, limit

    def __missing__(self, word):
        if len(self) >= self._limit:
            self.clear()
        h = self[word] = self._h(word)
        return h


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lowered.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` splits at exactly
    the six ASCII white-space bytes.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x):
    """Finaliser of splitmix64 on a uint64 array (a fixed bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(ws: list[bytes], n: int, memo: WordHash):
    """64-bit hash of each ``n``-word shingle, in text order (uint64 array).

    A text with fewer than ``n`` words has its whole word sequence as its
    only shingle; a text without words has none.
    """
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))
    k = min(n, len(ws))
    out = np.full(len(ws) - k + 1, k, np.uint64)
    for j in range(k):
        out = mix64(out ^ h[j:len(ws) - k + 1 + j])
    return out
