"""Registered source/sink queries.

Each writes data that Spark derives from the given tables to a fresh path
under the shared checkpoint folder (:func:`tessera.session.scratch_path`),
reads it back through the operator under test and returns that DataFrame.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.session import scratch_path
from tessera.sinks import writers as W
from tessera.sources import delimited as D
from tessera.sources.tables import movies, ratings, table


def rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated ``user, item, rating, epoch seconds`` lines."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(F.concat_ws(
        "\t", F.col("o_custkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.ceil(F.col("l_quantity") / 10).cast("double").cast("string"),
        F.unix_timestamp(F.col("o_orderdate")).cast("string")).alias("value"))


def movie_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``|``-separated movie lines: id, name, two dates, link, 17 flags.

    The dates use ``dd-MMM-yyyy`` / empty and the flags mix ``true``,
    ``false`` and ``1``: a declared-schema read keeps the row and turns the
    fields it cannot parse into NULL.
    """
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    flags = [F.when((s.s_nationkey + k) % 3 == 0, F.lit("true"))
              .when((s.s_nationkey + k) % 3 == 1, F.lit("false")).otherwise(F.lit("1"))
             for k in range(len(D.GENRE_COLUMNS))]
    return s.select(F.concat_ws(
        "|", F.col("s_suppkey").cast("string"), F.col("s_name"), F.lit("01-Jan-1995"), F.lit(""),
        F.when(s.s_suppkey % 7 == 0, "").when(s.s_suppkey % 7 == 1, "\\N")
         .otherwise(F.concat(F.lit("http://example.com/m/"), F.col("s_suppkey").cast("string"))), *flags
    ).alias("value"))


def _similarity(spark: SparkSession, sf: str) -> DataFrame:
    return S.similarity(ratings(spark, sf), "user_lt_item")


def q_scan_ratings_strict(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ratings-tsv")
    W.write_text(rating_lines(spark, sf), path)
    return D.read_ratings_strict(spark, path)


def q_scan_delimited_permissive(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "movies-psv")
    W.write_text(movie_lines(spark, sf), path)
    return D.read_delimited(spark, path, D.MOVIE_SCHEMA, "|")


def q_scan_external_similarity(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "similarity-txt")
    W.write_text(S.similarity_lines(_similarity(spark, sf)), path)
    with D.external_table(spark, path, D.SIMILARITY_SCHEMA, ",") as t:
        return t


def q_load_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    src, dst = scratch_path(spark, "load-src"), scratch_path(spark, "rating-table")
    # First load something else, then replace it: only the second load remains.
    W.write_text(movie_lines(spark, sf), src + "-old")
    D.load_overwrite(spark, src + "-old", D.RATING_SCHEMA, "\t", dst)
    W.write_text(rating_lines(spark, sf), src)
    return D.load_overwrite(spark, src, D.RATING_SCHEMA, "\t", dst)


def _parse_triples(df: DataFrame) -> DataFrame:
    f = F.split(F.col("value"), ",", -1)
    return df.select(f.getItem(0).cast("bigint").alias("movie1"),
                     f.getItem(1).cast("bigint").alias("movie2"),
                     f.getItem(2).cast("double").alias("corr"))


def user_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``|``-separated user lines; some ages are missing or no numbers."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    age = (F.when(c.c_custkey % 5 == 0, "\\N").when(c.c_custkey % 5 == 1, "unknown")
           .otherwise((c.c_nationkey + 18).cast("string")))
    return c.select(F.concat_ws("|", F.col("c_custkey").cast("string"), age,
                                F.when(c.c_custkey % 2 == 0, "M").otherwise("F"), F.lower("c_mktsegment"),
                                F.lpad((c.c_custkey % 100000).cast("string"), 5, "0")).alias("value"))


def q_load_users(spark: SparkSession, sf: str) -> DataFrame:
    src, dst = scratch_path(spark, "users-psv"), scratch_path(spark, "user-table")
    W.write_text(user_lines(spark, sf), src)
    return D.load_overwrite(spark, src, D.USER_SCHEMA, "|", dst)


def q_predictions_external(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions from the similarity lines another job wrote, read through an
    external table with a FLOAT column."""
    path = scratch_path(spark, "similarity-lines")
    W.write_text(S.similarity_lines(_similarity(spark, sf)), path)
    sim = D.read_delimited(spark, path, D.SIMILARITY_SCHEMA, ",").select(
        F.col("movieID1").cast("bigint").alias("movie1"), F.col("movieID2").cast("bigint").alias("movie2"),
        F.col("correlation_factor").alias("corr"))
    return P.predictions(ratings(spark, sf), sim, movies(spark, sf))


def q_sink_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sim-text")
    W.write_text(S.similarity_lines(_similarity(spark, sf)), path)
    return _parse_triples(spark.read.text(path))


def q_sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sim-csv")
    W.write_csv(_similarity(spark, sf), path)
    return spark.read.schema("movie1 bigint, movie2 bigint, corr double").csv(path)


def q_sink_parquet_codec(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "rws-parquet")
    W.write_parquet(S.ratings_with_size(ratings(spark, sf)), path, codec="GZIP")
    return spark.read.parquet(path)


def q_sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    W.write_parquet(P.liked_items(ratings(spark, sf)), path)
    W.write_parquet(S.raters_per_item(ratings(spark, sf)), path, mode="overwrite")
    return spark.read.parquet(path)


def q_sink_fail_if_exists(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "no-overwrite")
    W.write_parquet(S.raters_per_item(ratings(spark, sf)), path)
    try:
        W.write_parquet(P.liked_items(ratings(spark, sf)), path, mode="errorifexists")
    except AnalysisException:
        pass
    else:  # pragma: no cover - would be a Spark behaviour change
        raise RuntimeError("errorifexists wrote over an existing output")
    return spark.read.parquet(path)


def q_sink_sequencefile_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pred-seq")
    r = ratings(spark, sf)
    pred = P.predictions(r, S.similarity(r), movies(spark, sf))
    W.write_pairs(pred, path, "userid", "moviename")
    return W.read_pairs(spark, path, "userid bigint, moviename string")


QUERIES = {
    "scan_ratings_strict": q_scan_ratings_strict,
    "scan_delimited_permissive": q_scan_delimited_permissive,
    "scan_external_similarity": q_scan_external_similarity,
    "load_overwrite": q_load_overwrite,
    "load_users": q_load_users,
    "predictions_external": q_predictions_external,
    "sink_text_roundtrip": q_sink_text_roundtrip,
    "sink_csv_roundtrip": q_sink_csv_roundtrip,
    "sink_parquet_codec": q_sink_parquet_codec,
    "sink_overwrite": q_sink_overwrite,
    "sink_fail_if_exists": q_sink_fail_if_exists,
    "sink_sequencefile_roundtrip": q_sink_sequencefile_roundtrip,
}


def _oracle():
    from tessera.plans import oracle_cf as O
    flags = ", ".join(
        f"case (s_nationkey + {k}) % 3 when 0 then true when 1 then false else null end as {g}"
        for k, g in enumerate(D.GENRE_COLUMNS))
    sim = f"with {O.sim('user_lt_item')} select movie1, movie2, corr from sim"
    return {
        "scan_ratings_strict": f"with {O.RT} select * from rt",
        "scan_delimited_permissive": (
            "select cast(s_suppkey as integer) as movieID, s_name as movieName, "
            "cast(null as timestamp) as release_date, cast(null as timestamp) as video_release_date, "
            "case s_suppkey % 7 when 0 then '' when 1 then null else "
            f"'http://example.com/m/' || cast(s_suppkey as varchar) end as imdb_link, {flags} from supplier"),
        "scan_external_similarity": (
            f"with {O.sim('user_lt_item')} select cast(movie1 as integer) as movieID1, "
            "cast(movie2 as integer) as movieID2, cast(corr as float) as correlation_factor from sim"),
        "load_overwrite": (
            "select cast(o_custkey as integer) as userID, cast(l_suppkey as integer) as movieID, "
            "cast(ceil(l_quantity/10) as double) as rating, cast(epoch(o_orderdate) as integer) as time "
            "from lineitem join orders on l_orderkey = o_orderkey"),
        "load_users": (
            "select cast(c_custkey as integer) as userID, case when c_custkey % 5 > 1 "
            "then cast(c_nationkey + 18 as integer) end as age, "
            "case when c_custkey % 2 = 0 then 'M' else 'F' end as gender, lower(c_mktsegment) as occupation, "
            "lpad(cast(c_custkey % 100000 as varchar), 5, '0') as zip_code from customer"),
        "predictions_external": O.predictions(),
        "sink_text_roundtrip": sim,
        "sink_csv_roundtrip": sim,
        "sink_parquet_codec": O.ORACLE["ratings_with_size"],
        "sink_overwrite": O.ORACLE["raters_per_item"],
        "sink_fail_if_exists": O.ORACLE["raters_per_item"],
        "sink_sequencefile_roundtrip": O.predictions(),
    }


ORACLE = _oracle()
