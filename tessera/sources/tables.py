"""Loaders for the parquet tables and the stand-in inputs built from them.

Each loader selects only the columns it needs so that the parquet scan's
``ReadSchema`` stays narrow; filters added downstream are pushed into the
scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.skew import spread
from tessera.staging import shared

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    """Ratings ``(userid bigint, movieid bigint, rating double)``.

    Stand-in for a rating file: one rating per order line, the
    customer rates the supplier with ``ceil(quantity / 10)`` (1.0 .. 5.0).
    Repeated (customer, supplier) lines are kept — duplicates are part of
    the reproduced semantics.  With ``stage`` (default) the orders ⋈
    lineitem join runs once per application and is read back as a table,
    like the rating file it stands for (``tessera.staging.release(spark,
    "ratings:" + sf_dir)`` gives a use back); ``stage=False`` returns the lazy join.
    """
    if stage:
        return shared(spark, f"ratings:{sf_dir}", lambda: ratings(spark, sf_dir, stage=False))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = spread(li, "l_orderkey")  # files for every task that reads the ratings
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(F.col("o_custkey").alias("userid"),
                      F.col("l_suppkey").alias("movieid"),
                      F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie dimension ``(movieid bigint, moviename string)`` from ``supplier``."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("movieid"), F.col("s_name").alias("moviename"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def comma_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines ``value`` whose column 1 uses ``_`` for spaces."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return p.select(
        F.concat_ws(",", F.col("p_partkey").cast("string"),
                    F.replace(F.col("p_name"), F.lit(" "), F.lit("_")),
                    F.col("p_brand")).alias("value"),
        F.col("p_partkey"))
