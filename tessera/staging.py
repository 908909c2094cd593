"""Staged datasets: written once under the shared scratch folder, counted, removed.

A plan that reads one dataset several times, or several plans that share one,
scan a table written once instead of recomputing it (Catalyst prunes each
branch differently, so exchanges are not always reused); a lost executor costs
a re-read.  Staged tables do not stay:

* :func:`shared` counts its users: each :func:`shared` call is one, each
  :func:`release` takes one back, and the last one removes the table;
* :func:`staging` is a scope: what :func:`stage` writes inside is removed when
  the scope ends;
* whatever is left is removed when the driver's JVM exits.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tessera.session import remove_path, scratch_path

# (application id, key) -> [path, users]
_SHARED: dict[tuple[str, str], list] = {}
# open scopes, innermost last: the paths written in each
_SCOPES: list[list[str]] = []


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new scratch path that is removed at the latest when the driver exits."""
    path = scratch_path(spark, name)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` and return a scan of it; removed with the innermost open scope.

    With ``by`` each value of that column has a folder of its own.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_table(spark, name)
    out = df.write.mode("errorifexists")
    (out.partitionBy(by) if by else out).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return spark.read.schema(schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let the cleaner drop the shuffle files of plans nobody holds any more, such as
    those of a table just staged, now instead of at the driver's next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside once the block is left, however it is left."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_path(spark, path)


def shared(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The dataset called ``key``, written by the first user of this application."""
    k = (spark.sparkContext.applicationId, key)
    entry = _SHARED.get(k)
    if entry is None:
        path = scratch_table(spark, "staged-" + "".join(c if c.isalnum() else "_" for c in key)[-60:])
        build().write.mode("errorifexists").parquet(path)
        entry = _SHARED[k] = [path, 0]
    entry[1] += 1
    return spark.read.parquet(entry[0])


def users(spark: SparkSession, key: str) -> int:
    """How many users the shared dataset has (0: it is not staged)."""
    return _SHARED.get((spark.sparkContext.applicationId, key), [None, 0])[1]


def release(spark: SparkSession, key: str, everybody: bool = False) -> None:
    """Give one use (or, ``everybody``, all uses) of a shared dataset back."""
    k = (spark.sparkContext.applicationId, key)
    entry = _SHARED.get(k)
    if entry is None:
        return
    entry[1] = 0 if everybody else entry[1] - 1
    if entry[1] <= 0:
        del _SHARED[k]
        remove_path(spark, entry[0])
