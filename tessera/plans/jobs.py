"""File-to-file jobs: the end-to-end pipelines with path arguments.

Each job takes input paths, writes its outputs with the requested write
mode and returns a small summary (counts come from aggregates on the
cluster, never from collected rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.operators import text as T
from tessera.plans import prediction_script as H
from tessera.sinks import writers as W
from tessera.sources import delimited as D


def similarity_job(spark: SparkSession, ratings_path: str, output_path: str,
                   pair_filter: str = "user_lt_item", mode: str = "overwrite") -> DataFrame:
    """Tab-separated ratings → ``movie1,movie2,corr`` text lines.

    A malformed rating line fails the job; an existing output is replaced
    (``mode="overwrite"``) or refused (``"errorifexists"``).
    """
    sim = S.similarity(D.read_ratings_strict(spark, ratings_path), pair_filter)
    W.write_text(S.similarity_lines(sim), output_path, mode=mode)
    return spark.read.text(output_path)


def word_count_job(spark: SparkSession, input_path: str, output_path: str | None = None,
                   mode: str = "overwrite") -> dict:
    """Lines → tokens (Java ``split(" ")``); optionally saves the tokens as text."""
    lines = spark.read.text(input_path)
    counts = T.word_count_total(lines).first()
    if output_path:
        W.write_text(T.tokenize(lines).select("word"), output_path, mode=mode)
    return {"lines": counts["lines"], "words": counts["words"] or 0}


def column_correction_job(spark: SparkSession, input_path: str, output_path: str,
                          mode: str = "overwrite") -> DataFrame:
    """Comma lines → lines with ``_`` replaced by a space in column 1."""
    W.write_text(T.correct_columns(spark.read.text(input_path)), output_path, mode=mode)
    return spark.read.text(output_path)


def prediction_job(spark: SparkSession, ratings_path: str, movies_path: str,
                   similarity_path: str) -> DataFrame:
    """The table script over text inputs: ratings (tab), movies (``|``) and the
    similarity lines written by :func:`similarity_job` (read as FLOAT)."""
    ratings = D.read_delimited(spark, ratings_path, D.RATING_SCHEMA, "\t").select(
        F.col("userID").alias("userid"), F.col("movieID").alias("movieid"), "rating")
    movies = D.read_delimited(spark, movies_path, D.MOVIE_SCHEMA, "|").select(
        F.col("movieID").alias("movieid"), F.col("movieName").alias("moviename"))
    sim = D.read_delimited(spark, similarity_path, D.SIMILARITY_SCHEMA, ",").select(
        F.col("movieID1").alias("movieid1"), F.col("movieID2").alias("movieid2"),
        F.col("correlation_factor").cast("double").alias("correlation_factor"))
    return H.prediction_tables(spark, ratings, sim, movies)


def lazy_predictions(spark: SparkSession, ratings_path: str, movies_path: str,
                     candidates: str = "seen", narrow: bool = True,
                     pair_filter: str = "user_lt_item") -> DataFrame:
    """Ratings and movie files → predictions as one lazy plan (no tables)."""
    ratings = D.read_ratings_strict(spark, ratings_path)
    movies = D.read_delimited(spark, movies_path, D.MOVIE_SCHEMA, "|").select(
        F.col("movieID").cast("bigint").alias("movieid"), F.col("movieName").alias("moviename"))
    return P.predictions(ratings, S.similarity(ratings, pair_filter), movies, candidates, narrow)
