"""Named shared datasets: get-or-create, list, get, update.

A named dataset is a session temporary view whose data is cached
(memory, spilling to disk); lost cache blocks are recomputed from the
lineage, so executor loss never loses the dataset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "named_"


def _view(name: str) -> str:
    return _PREFIX + name


def get_or_create(spark: SparkSession, name: str, factory: Callable[[], DataFrame]) -> DataFrame:
    view = _view(name)
    if spark.catalog.tableExists(view):
        return spark.table(view)
    return update(spark, name, factory())


def get(spark: SparkSession, name: str) -> DataFrame | None:
    view = _view(name)
    return spark.table(view) if spark.catalog.tableExists(view) else None


def names(spark: SparkSession) -> list[str]:
    return sorted(t.name[len(_PREFIX):] for t in spark.catalog.listTables()
                  if t.isTemporary and t.name.startswith(_PREFIX))


def update(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Replace the dataset; the new data is cached, the old cache released."""
    view = _view(name)
    if spark.catalog.tableExists(view):
        spark.catalog.uncacheTable(view)
    df.createOrReplaceTempView(view)
    spark.catalog.cacheTable(view)
    return spark.table(view)


def drop(spark: SparkSession, name: str) -> None:
    view = _view(name)
    if spark.catalog.tableExists(view):
        spark.catalog.uncacheTable(view)
        spark.catalog.dropTempView(view)
