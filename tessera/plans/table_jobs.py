"""Registered table DDL/DML queries (CTAS chain, typed append tables, named datasets)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import named as N
from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.plans import oracle_cf as O
from tessera.plans import prediction_script as H
from tessera.session import scratch_path
from tessera.sources.tables import movies, ratings


def _inputs(spark: SparkSession, sf: str):
    r = ratings(spark, sf)
    return r, P.similarity_table(S.similarity(r, "user_lt_item"), narrow=True)


def q_ctas(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _inputs(spark, sf)
    return H.candidate_table(spark, r, st)


def q_insert_append(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _inputs(spark, sf)
    return H.prediction_tables(spark, r, st, movies(spark, sf))


def q_named_dataset(spark: SparkSession, sf: str) -> DataFrame:
    name = f"raters_{uuid.uuid4().hex[:8]}"
    first = N.get_or_create(spark, name, lambda: S.raters_per_item(ratings(spark, sf)))
    again = N.get_or_create(spark, name, lambda: None)  # served from the catalog
    assert again.columns == first.columns and name in N.names(spark)
    path = scratch_path(spark, "named")
    N.update(spark, name, again.withColumn("num_raters", F.col("num_raters") * 10)).write.parquet(path)
    N.drop(spark, name)  # leaves no cached view behind
    return spark.read.parquet(path)


QUERIES = {
    "ctas": q_ctas,
    "insert_append": q_insert_append,
    "named_dataset": q_named_dataset,
}

ORACLE = {
    "ctas": O.ORACLE["candidates_seen"],
    "insert_append": (f"with {O.chain()} select distinct cast(b.userid as integer) as userid, "
                      "s.s_name as moviename from best b join supplier s on b.movieid2 = s.s_suppkey"),
    "named_dataset": (f"with {O.RT} select movieid, count(*) * 10 as num_raters from rt "
                      "group by movieid"),
}
