"""Predictions as tables: each step saved, typed result tables filled by inserts.

For users who want the steps themselves as tables.  The steps are the
operators of :mod:`tessera.operators.predictions`, saved one by one (CTAS);
already-rated candidates come from the blocked pairs, so liked × similarity is
never written.  Result tables declare their types, and the inserts widen the
FLOAT correlations to DOUBLE.

Every run works in a database of its own below the scratch folder, made
current while the run lasts and dropped with its tables at the end.  The
results are external tables: their files stay and are what is returned.
No view or table of the caller is touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.session import scratch_path


@contextmanager
def own_database(spark: SparkSession) -> Iterator[str]:
    """A new current database, dropped with its tables on leaving."""
    name, before = f"run_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_path(spark, name)}'")
    spark.sql(f"USE {name}")
    try:
        yield name
    finally:
        spark.sql(f"USE {before}")
        spark.sql(f"DROP DATABASE {name} CASCADE")


def save_step(spark: SparkSession, name: str, step: DataFrame, path: str | None = None) -> DataFrame:
    """Replace the table by the step's rows; with ``path`` the files outlive it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = step.write.format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def _candidates(spark: SparkSession, ratings: DataFrame, sim_table: DataFrame, path: str | None) -> DataFrame:
    """Four saved steps up to the already-rated candidates."""
    narrow = F.col("correlation_factor").cast("float")
    sim = save_step(spark, "similar_items", P.drop_self_pairs(sim_table).withColumn("correlation_factor", narrow))
    liked = save_step(spark, "liked", P.liked_items(ratings))
    rated = save_step(spark, "ratings_of_likers", ratings.join(liked.select("userid").distinct(), "userid", "left_semi"))
    return save_step(spark, "rated_candidates", P.seen_candidates(rated, sim), path)


def candidate_table(spark: SparkSession, ratings: DataFrame, sim_table: DataFrame) -> DataFrame:
    """The already-rated candidates as a table another job can read."""
    path = scratch_path(spark, "rated-candidates")
    with own_database(spark):
        _candidates(spark, ratings, sim_table, path)
    return spark.read.parquet(path).withColumn("correlation_factor", F.col("correlation_factor").cast("double"))


def prediction_tables(spark: SparkSession, ratings: DataFrame, sim_table: DataFrame,
                      movies: DataFrame) -> DataFrame:
    """All steps; returns ``(userid int, moviename string)``.

    The best candidates arrive in two appends, likes of odd and of even items,
    so the second goes into a table that has rows.
    """
    path = scratch_path(spark, "user-predictions")
    with own_database(spark):
        cands = _candidates(spark, ratings, sim_table, None)
        spark.sql("CREATE TABLE best_rated (userid INT, movieid1 INT, movieid2 INT, correlation DOUBLE) USING parquet")
        best = P.best_candidates(cands).withColumn("correlation", F.col("correlation").cast("float"))
        for odd in (True, False):
            half = best.where((F.col("movieid1") % 2 != 0) == F.lit(odd))
            half.select(F.col("userid").cast("int"), F.col("movieid1").cast("int"), F.col("movieid2").cast("int"),
                        "correlation").write.insertInto("best_rated")
        spark.sql(f"CREATE TABLE user_predictions (userid INT, moviename STRING) USING parquet LOCATION '{path}'")
        named = P.predictions_from_best(spark.table("best_rated"), movies)
        named.select(F.col("userid").cast("int"), "moviename").write.insertInto("user_predictions")
        for step in ("similar_items", "liked", "ratings_of_likers", "rated_candidates"):
            spark.sql(f"DROP TABLE IF EXISTS {step}")
    return spark.read.schema("userid int, moviename string").parquet(path)
