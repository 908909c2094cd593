"""Registered collaborative-filtering queries: ``(spark, sf_dir) -> DataFrame``.

Ratings and movies are the stand-ins of :mod:`tessera.sources.tables`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.sources.tables import movies, ratings


def q_raters_per_item(spark: SparkSession, sf: str) -> DataFrame:
    return S.raters_per_item(ratings(spark, sf))


def q_ratings_with_size(spark: SparkSession, sf: str) -> DataFrame:
    return S.ratings_with_size(ratings(spark, sf))


def q_pair_stats(spark: SparkSession, sf: str) -> DataFrame:
    return S.pair_stats(ratings(spark, sf), "user_lt_item")


def q_pair_stats_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return S.pair_stats(ratings(spark, sf), "item_lt_item")


def q_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return S.similarity(ratings(spark, sf), "user_lt_item")


def q_similarity_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return S.similarity(ratings(spark, sf), "item_lt_item")


def q_similarity_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Processed / kept / dropped pair counts of the similarity job."""
    c = S.correlations(S.pair_sums(ratings(spark, sf), "user_lt_item"))
    kept = F.col("corr").isNotNull() & ~F.isnan(F.col("corr"))
    return c.agg(F.count(F.lit(1)).alias("pairs"),
                 F.count_if(kept).alias("kept"),
                 F.count_if(~kept).alias("dropped"))


def _steps(spark: SparkSession, sf: str, narrow: bool = True, pair_filter: str = "user_lt_item"):
    r = ratings(spark, sf)
    st = P.similarity_table(S.similarity(r, pair_filter), narrow)
    return r, st


def q_liked_items(spark: SparkSession, sf: str) -> DataFrame:
    return P.liked_items(ratings(spark, sf))


def q_similar_per_user(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.similar_per_user(r, st)


def q_drop_self_pairs(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.drop_self_pairs(P.similar_per_user(r, st))


def q_candidates_outer(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.candidates_outer(P.drop_self_pairs(P.similar_per_user(r, st)), r)


def q_candidates_seen(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.seen_candidates(r, st)


def q_candidates_unseen(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.candidates_unseen(P.drop_self_pairs(P.similar_per_user(r, st)), r)


def q_max_correlation(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.max_seen_correlation(r, st)


def q_best_candidates_joinback(spark: SparkSession, sf: str) -> DataFrame:
    r, st = _steps(spark, sf)
    return P.best_candidates_joinback(P.seen_candidates(r, st))


def _best(candidates: str, narrow: bool = True, pair_filter: str = "user_lt_item"):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        r = ratings(spark, sf)
        return P.best_candidates_for(r, S.similarity(r, pair_filter), candidates, narrow)
    return q


def _pred(candidates: str, narrow: bool = True, pair_filter: str = "user_lt_item"):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        r = ratings(spark, sf)
        return P.predictions(r, S.similarity(r, pair_filter), movies(spark, sf), candidates, narrow)
    return q


QUERIES = {
    "raters_per_item": q_raters_per_item,
    "ratings_with_size": q_ratings_with_size,
    "pair_stats": q_pair_stats,
    "pair_stats_ordered": q_pair_stats_ordered,
    "similarity": q_similarity,
    "similarity_ordered": q_similarity_ordered,
    "similarity_stats": q_similarity_stats,
    "liked_items": q_liked_items,
    "similar_per_user": q_similar_per_user,
    "drop_self_pairs": q_drop_self_pairs,
    "candidates_outer": q_candidates_outer,
    "candidates_seen": q_candidates_seen,
    "candidates_unseen": q_candidates_unseen,
    "max_correlation": q_max_correlation,
    "best_candidates": _best("seen"),
    "best_candidates_double": _best("seen", narrow=False),
    "best_candidates_unseen": _best("unseen"),
    "best_candidates_joinback": q_best_candidates_joinback,
    "predictions": _pred("seen"),
    "predictions_double": _pred("seen", narrow=False),
    "predictions_unseen": _pred("unseen"),
    "predictions_ordered": _pred("seen", pair_filter="item_lt_item"),
    "predictions_ordered_unseen": _pred("unseen", pair_filter="item_lt_item"),
}
