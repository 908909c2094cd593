"""Hot keys: one user holds a third of all rating rows (many items, many duplicates)."""
import pytest
from pyspark.sql import functions as F

from tessera.operators import predictions as P
from tessera.operators import similarity as S
from tessera.operators import skew as K
from support import rows


@pytest.fixture(scope="module")
def skewed(spark):
    base = spark.range(0, 600).select(
        (F.col("id") % 40 + 100).alias("userid"), (F.col("id") % 37 + 1).alias("movieid"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"))
    hot = spark.range(0, 300).select(
        F.lit(7).cast("bigint").alias("userid"), (F.col("id") % 60 + 1).alias("movieid"),
        ((F.col("id") * 7) % 5 + 1).cast("double").alias("rating"))
    return base.unionByName(hot)


def brute_pair_sums(spark, df, cond):
    df.createOrReplaceTempView("skew_rt")
    return spark.sql(f"""select a.movieid movie1, b.movieid movie2, count(*) size,
        sum(a.rating*b.rating) dot_product, sum(a.rating) rating_sum, sum(b.rating) rating2_sum,
        sum(a.rating*a.rating) rating_sq, sum(b.rating*b.rating) rating2_sq
        from skew_rt a join skew_rt b on a.userid = b.userid where {cond}
        group by a.movieid, b.movieid""")


@pytest.mark.parametrize("pair_filter,cond", [("user_lt_item", "a.userid < b.movieid"),
                                              ("item_lt_item", "a.movieid < b.movieid")])
@pytest.mark.parametrize("block_size", [4, 64])
def test_hot_user_pair_sums_exact(spark, skewed, pair_filter, cond, block_size):
    assert skewed.where("userid = 7").count() * 3 == skewed.count()
    got = rows(S.pair_sums(skewed, pair_filter, block_size=block_size)
                .select("movie1", "movie2", "size", "dot_product", "rating_sum", "rating2_sum",
                        "rating_sq", "rating2_sq"))
    assert got == rows(brute_pair_sums(spark, skewed, cond)) and len(got) > 0


def test_hot_user_predictions_exact(spark, skewed):
    sim = S.similarity(skewed, "item_lt_item", block_size=4)
    st = P.similarity_table(sim)
    spu = P.drop_self_pairs(P.similar_per_user(skewed, st))
    for mode, cands in [("seen", P.candidates_seen(spu, skewed)),
                        ("unseen", P.candidates_unseen(spu, skewed))]:
        exp = rows(P.best_candidates_joinback(cands))
        assert rows(P.best_candidates_for(skewed, sim, mode, block_size=4)) == exp


def test_no_cartesian_or_nested_loop_plans(spark, skewed):
    sim = S.similarity(skewed)
    for df in [sim, P.best_candidates_for(skewed, sim, "seen"),
               P.best_candidates_for(skewed, sim, "unseen"),
               P.seen_candidates(skewed, P.similarity_table(sim))]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pairs_are_formed_in_pinned_partitions_of_one_exchange(spark, skewed, monkeypatch):
    monkeypatch.setattr(K, "PAIRS_PER_TASK", 1000)
    df = S.pair_sums(skewed, "item_lt_item")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "shufflepartitionidpassthrough" in plan and "REPARTITION_BY_NUM" in plan  # not coalesced by AQE
    assert plan.count("Join") == 1 and "SortMergeJoin" in plan  # no user is hot at this block size
    join = plan[plan.index("SortMergeJoin"):]
    assert join.index("Sort [") < join.index("Exchange") and "hashpartitioning(_p" not in plan
    hot = S.pair_sums(skewed, "item_lt_item", block_size=4)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [userid" in hot  # a small, checked list of hot users


def _unordered(spark, degrees, **kw):
    sizes = spark.createDataFrame(list(enumerate(degrees)), "userid bigint, _deg bigint")
    return K.plan_pairs(sizes, "userid", **kw)


def test_twice_the_pairs_make_twice_the_tasks(spark):
    one = _unordered(spark, [30] * 2000, pairs_per_task=20_000)
    two = _unordered(spark, [30] * 4000, pairs_per_task=20_000)
    assert one.pairs == 2000 * 900 and one.tasks == 90 and two.tasks == 180
    assert len(one.cells) >= 16 * one.tasks and sorted(set(one.cells)) == list(range(90))


@pytest.mark.parametrize("ordered", [False, True])
def test_no_partition_above_twice_the_mean(spark, ordered):
    degrees = [1 + i % 50 for i in range(5000)] + [400] * 3 + [3000]  # the last has over half of all pairs
    plan = _unordered(spark, degrees, block_size=100, ordered=ordered, pairs_per_task=200_000)
    assert plan.heaviest * plan.tasks <= 2 * plan.pairs and plan.tasks > 20
    assert plan.hot_keys == 4 and plan.bounds == 3 * 4 + 30


def test_partitions_follow_the_plan(spark):
    rows_ = [(u, i) for u in range(60) for i in range(20)] + [(99, i) for i in range(300)]
    df = spark.createDataFrame(rows_, "u bigint, i bigint")
    plan = K.plan_pairs(K.degrees(df, "u"), "u", 32, True, 2000)
    got = K.blocked_self_join(df, "u", "i", [F.col("i").alias("a")], [F.col("i").alias("b")], block_size=32,
                              ordered=True, pairs_per_task=2000)
    parts = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 60 * 190 + 300 * 299 // 2 and len(parts) > 20
    assert max(parts) <= 2.5 * plan.pairs / plan.tasks


def test_each_ordered_pair_is_formed_once(spark):
    """The join's own condition: it hands on each pair once, and no filter follows."""
    items = [-7, -1, 0, 1, 2, 3, 50, 51, 52, 10**12] + list(range(100, 160))
    df = spark.createDataFrame([(1, i) for i in items] + [(2, 5), (2, 6), (None, 1), (None, 2)], "u bigint, i bigint")
    for size in (1, 3, 7, 64, 500):
        got = K.blocked_self_join(df, "u", "i", [F.col("i").alias("a")], [F.col("i").alias("b")],
                                  block_size=size, ordered=True)
        assert rows(got) == sorted([(1, a, b) for a in items for b in items if a < b] + [(2, 5, 6)])
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.splitlines()[1].strip().startswith("+- Join Inner") and "_x" in plan.splitlines()[1]


def test_unordered_join_with_filters_and_repeats(spark):
    src = [(u, i % 9, i % 4) for u in (1, 2) for i in range(40 * u)] + [(3, None, 1), (None, 1, 3)]
    df = spark.createDataFrame(src, "u bigint, i bigint, v bigint")
    expected = sorted(((a[0], a[1], a[2], b[1]) for a in src for b in src
                       if a[0] is not None and a[0] == b[0] and a[2] > 1 and b[2] < 3),
                      key=lambda t: tuple((v is not None, v or 0) for v in t))
    for size in (4, 1000):
        got = K.blocked_self_join(df, "u", "i", [F.col("i").alias("a"), F.col("v").alias("x")], [F.col("i").alias("b")],
                                  left_filter=F.col("v") > 1, right_filter=F.col("v") < 3, block_size=size)
        assert rows(got) == expected
