import pytest
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.sources.tables import movies, ratings
from support import SF_SMALL, rows

RS = "userid bigint, movieid bigint, rating double"
SS = "movie1 bigint, movie2 bigint, corr double"
CS = "userid bigint, movieid1 bigint, movieid2 bigint, correlation_factor double, rating double"


def test_ties_are_kept(spark):
    c = spark.createDataFrame([(1, 10, 20, 0.9, 5.0), (1, 10, 21, 0.9, 4.0), (1, 10, 22, 0.1, 3.0)], CS)
    assert rows(P.best_candidates(c)) == [(1, 10, 20, 0.9), (1, 10, 21, 0.9)]
    assert rows(P.best_candidates_joinback(c)) == rows(P.best_candidates(c))


def test_all_null_group_has_no_row(spark):
    c = spark.createDataFrame([(1, 10, 20, None, 5.0), (1, 10, 21, None, 4.0)], CS)
    assert P.best_candidates(c).count() == 0
    assert P.best_candidates_joinback(c).count() == 0


def test_seen_candidates_and_duplicates(spark):
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 3.0), (1, 20, 4.0), (1, 30, 2.0)], RS)
    sim = spark.createDataFrame([(10, 20, 0.5), (10, 30, 0.5), (10, 40, 0.9), (10, 10, 1.0)], SS)
    best = P.best_candidates_for(r, sim, "seen", narrow=False)
    # 20 is rated twice -> two rows; 40 is unseen; the self pair is dropped
    assert rows(best) == [(1, 10, 20, 0.5), (1, 10, 20, 0.5), (1, 10, 30, 0.5)]
    unseen = P.best_candidates_for(r, sim, "unseen", narrow=False)
    assert rows(unseen) == [(1, 10, 40, 0.9)]


def test_float_narrowing_creates_ties(spark):
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 3.0), (1, 30, 2.0)], RS)
    sim = spark.createDataFrame([(10, 20, 0.8660254037844387), (10, 30, 0.8660254037844386)], SS)
    assert P.best_candidates_for(r, sim, "seen", narrow=True).count() == 2
    assert P.best_candidates_for(r, sim, "seen", narrow=False).count() == 1


@pytest.mark.parametrize("mode", ["seen", "unseen"])
@pytest.mark.parametrize("narrow", [True, False])
def test_scalable_path_equals_step_path(spark, mode, narrow):
    r = ratings(spark, SF_SMALL)
    sim = S.similarity(r)
    st = P.similarity_table(sim, narrow)
    spu = P.drop_self_pairs(P.similar_per_user(r, st))
    cands = P.candidates_seen(spu, r) if mode == "seen" else P.candidates_unseen(spu, r)
    exp = rows(P.best_candidates_joinback(cands))
    got = rows(P.best_candidates_for(r, sim, mode, narrow, block_size=3))
    assert got == exp and len(got) > 0
    pred = rows(P.predictions(r, sim, movies(spark, SF_SMALL), mode, narrow))
    assert pred == rows(P.predictions_from_best(P.best_candidates(cands), movies(spark, SF_SMALL)))


def test_seen_plus_unseen_is_all_candidates(spark):
    r = ratings(spark, SF_SMALL).dropDuplicates(["userid", "movieid"])
    st = P.similarity_table(S.similarity(r))
    spu = P.drop_self_pairs(P.similar_per_user(r, st))
    seen = P.candidates_seen(spu, r).drop("rating")
    unseen = P.candidates_unseen(spu, r).drop("rating")
    assert seen.count() + unseen.count() == spu.count()
    assert seen.unionByName(unseen).exceptAll(spu).count() == 0


def test_bad_mode(spark):
    r = spark.createDataFrame([(1, 10, 5.0)], RS)
    with pytest.raises(ValueError):
        P.best_candidates_for(r, spark.createDataFrame([], SS), "maybe")


def test_unseen_level_pruning_is_exact(spark):
    # user 1 rated item 10 (liked) and the three most similar items 20, 21, 22,
    # so the best unseen candidates sit at the 4th correlation level: a tie of 23 and 24.
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 1.0), (1, 21, 1.0), (1, 22, 2.0), (1, 22, 3.0)], RS)
    sim = spark.createDataFrame([(10, 10, 1.0), (10, 20, 0.9), (10, 21, 0.8), (10, 22, 0.7),
                                 (10, 23, 0.6), (10, 24, 0.6), (10, 25, 0.5)], SS)
    got = rows(P.best_candidates_for(r, sim, "unseen", narrow=False))
    assert got == [(1, 10, 23, 0.6), (1, 10, 24, 0.6)]


def test_seen_candidates_fast_path_equals_outer_join_filter(spark):
    r = ratings(spark, SF_SMALL)
    extra = spark.createDataFrame([(1, 1, 5.0), (1, 1, 4.0), (1, 2, None)], RS)
    r = r.unionByName(extra)
    st = P.similarity_table(S.similarity(r))
    spu = P.drop_self_pairs(P.similar_per_user(r, st))
    exp = rows(P.candidates_outer(spu, r).where("rating is not null"))
    assert rows(P.seen_candidates(r, st, block_size=2)) == exp and len(exp) > 0


def test_expand_splits_large_multiplicities(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (3, 10)], "k bigint, mult bigint")
    got = P._expand(df, "mult", chunk=3)
    assert sorted(r.k for r in got.collect()) == [1] * 5 + [2] + [3] * 10


def test_popular_levels_are_dealt_over_copies(spark):
    r = ratings(spark, SF_SMALL)
    st = P.similarity_table(S.similarity(r))
    many = rows(P._unseen_pairs(r, st, users_per_copy=1))
    one = rows(P._unseen_pairs(r, st))
    assert many == one and len(many) > 0


def test_an_item_liked_by_every_user_spans_partitions(spark):
    r = spark.range(3000).selectExpr("id as userid", "10L as movieid", "5.0D as rating")
    sim = spark.createDataFrame([(10, 20, 0.5), (10, 21, 0.5), (10, 10, 1.0)], SS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = P._unseen_pairs(r, P.similarity_table(sim), users_per_copy=100)
        parts = pairs.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(x["count"] for x in parts) == 6000 and len(parts) > 1
    assert max(x["count"] for x in parts) < 4500


def test_repeated_similarity_rows_are_kept(spark):
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 1.0)], RS)
    sim = spark.createDataFrame([(10, 20, 0.9), (10, 20, 0.9), (10, 21, 0.6), (10, 21, 0.6)], SS)
    got = rows(P.best_candidates_for(r, sim, "unseen", narrow=False))
    assert got == [(1, 10, 21, 0.6), (1, 10, 21, 0.6)]


def _exchanges(df):
    return [n for n in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in n]


def test_seen_pairs_are_neither_shuffled_nor_windowed_anew(spark):
    r = spark.createDataFrame([(u, m, float(m % 5 + 1)) for u in range(60) for m in range(20)], RS)
    sim = S.similarity(r, "item_lt_item")
    for out in (P.best_candidate_groups(r, sim), P.max_seen_correlation(r, P.similarity_table(sim))):
        assert not [e for e in _exchanges(out) if "movieid1#" in e and "movieid2#" in e or "hashpartitioning(userid" in e
                    and "movieid1#" in e], _exchanges(out)


def test_items_that_many_users_like_are_copied(spark):
    r = spark.createDataFrame([(u, m, float((u + m) % 5 + 1)) for u in range(40) for m in range(12) if (u * m) % 7]
                              + [(1, 3, 5.0), (1, 3, 5.0), (None, 3, 5.0), (2, None, 5.0)], RS)
    st = P.similarity_table(S.similarity(r.where("userid is not null and movieid is not null"), "item_lt_item"))
    liked = r.where("rating > 4").select("userid", F.col("movieid").alias("movieid1"))
    rated = r.select("userid", F.col("movieid").alias("movieid2"))
    exp = rows(P.candidates_seen(P.drop_self_pairs(P.similar_per_user(r, st)), r).drop("rating"))
    got = P._dealt_candidates(r, st, liked, rated, block_size=3, users_per_copy=2)
    assert exp and rows(got.select("userid", "movieid1", "movieid2", "correlation_factor")) == exp


def test_join_back_reads_its_candidates_once(spark):
    cands = spark.createDataFrame([(1, 10, 20, 0.9, 5.0), (1, 10, 21, 0.9, 4.0), (None, 10, 21, 0.9, 4.0),
                                   (1, 11, 22, None, 3.0)], CS).repartition(4, "movieid2")
    out = P.best_candidates_joinback(cands)
    assert rows(out) == [(1, 10, 20, 0.9), (1, 10, 21, 0.9)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnotnull(correlation_factor") == 2  # both branches alike


def test_unseen_names_of_a_user_meet_in_one_partition(spark):
    r = spark.createDataFrame([(1, 10, 5.0), (1, 20, 3.0), (2, 10, 5.0)], RS)
    sim = spark.createDataFrame([(10, 20, 0.5), (10, 30, 0.9), (10, 31, 0.9)], SS)
    mv = spark.createDataFrame([(30, "a"), (31, "a"), (20, "b")], "movieid bigint, moviename string")
    out = P.predictions(r, sim, F.broadcast(mv), "unseen")
    assert rows(out) == [(1, "a"), (2, "a")]
    assert not [e for e in _exchanges(out) if "moviename" in e and "hashpartitioning" in e]


def test_unseen_rows_are_not_sent_once_spelled_out(spark, monkeypatch):
    monkeypatch.setattr(P, "EXPAND_CHUNK", 3)
    # user 1 likes item 1 ten times; items 2 and 3 tie as the best unseen
    r = spark.createDataFrame([(1, 1, 5.0)] * 10 + [(1, 4, 2.0), (2, 4, 5.0), (2, 4, 1.0)],
                              "userid long, movieid long, rating double")
    sim = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5), (1, 4, 0.9), (4, 1, 0.25)], "movie1 long, movie2 long, corr double")
    best = P.best_candidates_for(r, sim, "unseen")
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan.split("Window")[0]
    assert sorted(map(tuple, best.collect())) == [(1, 1, 2, 0.5)] * 10 + [(1, 1, 3, 0.5)] * 10 + [(2, 4, 1, 0.25)]
    chunks = P.unseen_bitmaps(r, P.similarity_table(sim), chunk=3).where("userid = 1")
    assert sorted(x.liked_cnt for x in chunks.collect()) == [1, 3, 3, 3]  # ranked apart, so by several tasks


def test_levels_are_ranked_where_they_are_made(spark):
    r = spark.createDataFrame([(u, m, float((u + m) % 5 + 1)) for u in range(40) for m in range(12) if (u * m) % 7]
                              + [(None, 3, 5.0), (2, None, 5.0)], RS)
    st = P.similarity_table(S.similarity(r.where("userid is not null and movieid is not null"), "item_lt_item"))
    plan = P.level_bitmaps(st)._jdf.queryExecution().executedPlan().toString()
    levels = plan[:plan.index("Generate")] if "Generate" in plan else plan
    assert "Window" in levels and not [e for e in levels[:levels.index("movieid2")].split("\n") if "Exchange" in e]
