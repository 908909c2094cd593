import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import similarity as S
from tessera.sources.tables import ratings
from support import SF_SMALL, rows

SCHEMA = "userid bigint, movieid bigint, rating double"


def brute_force(data, pair_filter):
    """Pearson per item pair from every joined rating pair (the definition)."""
    groups = {}
    for u1, m1, r1 in data:
        for u2, m2, r2 in data:
            if u1 != u2:
                continue
            keep = u2 < m2 if pair_filter == "user_lt_item" else m1 < m2
            if keep:
                groups.setdefault((m1, m2), []).append((r1, r2))
    out = {}
    for k, v in groups.items():
        n = len(v)
        dot = sum(x * y for x, y in v)
        s1, s2 = sum(x for x, _ in v), sum(y for _, y in v)
        q1, q2 = sum(x * x for x, _ in v), sum(y * y for _, y in v)
        den = math.sqrt(n * q1 - s1 * s1) * math.sqrt(n * q2 - s2 * s2)
        if den == 0:
            continue
        c = (n * dot - s1 * s2) / den
        if not math.isnan(c):
            out[k] = c
    return out


DATA = [(1, 10, 5.0), (1, 11, 3.0), (1, 12, 4.0),
        (2, 10, 4.0), (2, 11, 2.0), (2, 12, 5.0),
        (3, 10, 1.0), (3, 11, 5.0), (3, 12, 2.0),
        (4, 10, 3.0), (4, 11, 3.0), (4, 12, 3.0),
        (2, 10, 2.0)]  # a duplicate (user, item) rating


@pytest.mark.parametrize("pair_filter", ["user_lt_item", "item_lt_item"])
@pytest.mark.parametrize("block_size", [1, 2, 2048])
def test_similarity_matches_definition(spark, pair_filter, block_size):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = {(r.movie1, r.movie2): r.corr for r in S.similarity(df, pair_filter, block_size).collect()}
    exp = brute_force(DATA, pair_filter)
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)


def test_as_written_filter_keeps_both_orders_and_self_pairs(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    keys = {(r.movie1, r.movie2) for r in S.similarity(df).collect()}
    assert (10, 11) in keys and (11, 10) in keys


def test_single_rater_pair_has_no_row(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 3.0)], SCHEMA)
    assert S.similarity(df, "item_lt_item").count() == 0


def test_zero_variance_drops_without_error(spark):
    df = spark.createDataFrame([(1, 10, 3.0), (1, 11, 1.0), (2, 10, 3.0), (2, 11, 5.0)], SCHEMA)
    assert S.similarity(df, "item_lt_item").count() == 0
    assert S.pair_sums(df, "item_lt_item").count() == 1


def test_duplicates_multiply_pairs(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    r = S.pair_stats(df, "item_lt_item").where("movie1 = 10 and movie2 = 11").first()
    # user 2 rated item 10 twice: 4 users + 1 extra pair
    assert r.size == 5 and r.num_raters == 5 and r.num_raters2 == 4


def test_blocking_equals_plain_on_tables(spark):
    r = ratings(spark, SF_SMALL)
    a = rows(S.pair_stats(r, "user_lt_item", block_size=2048))
    b = rows(S.pair_stats(r, "user_lt_item", block_size=2))
    assert a == b and len(a) > 0


def test_similarity_lines_format(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (3, 4, 1e-5)], "movie1 bigint, movie2 bigint, corr double")
    assert rows(S.similarity_lines(df)) == [("1,2,0.5",), ("3,4,1.0E-5",)]


def test_plan_has_no_cartesian_and_partial_aggregation(spark):
    plan = S.similarity(ratings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "partial_sum" in plan


def test_infinite_correlation_is_kept(spark):
    # zero variance on one side and a rounding remainder in the numerator
    r = spark.createDataFrame([(u, m, x) for m, xs in ((101, (0.2, 0.2, 0.2)), (102, (2.0, 3.0, 2.8)))
                               for u, x in enumerate(xs)], "userid bigint, movieid bigint, rating double")
    got = {(x.movie1, x.movie2): x["corr"] for x in S.similarity(r, "item_lt_item").collect()}
    assert got == {(101, 102): float("-inf")}


def test_no_window_over_a_user(spark):
    r = spark.createDataFrame([(1, 2, 3.0)], "userid bigint, movieid bigint, rating double")
    plan = S.similarity(r)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("block_size", [3, 2048])
def test_ordered_pairs_meet_in_grid_cells(spark, block_size, monkeypatch):
    monkeypatch.setattr(S.skew, "GRID_PAIRS", 0)
    data = [(u, m, float((u * m) % 5 + 1)) for u in range(1, 9) for m in range(100, 100 + 3 * u) if (u + m) % 3]
    data += [(1, 100, 2.0), (8, 110, 4.0), (8, 110, 1.0), (9, None, 3.0), (9, 101, 3.0), (None, 101, 3.0)]
    df = spark.createDataFrame(data, SCHEMA).cache()
    got = {(r.movie1, r.movie2): r.corr for r in S.similarity(df, "item_lt_item", block_size).collect()}
    exp = brute_force([d for d in data if None not in d], "item_lt_item")
    assert got.keys() == exp.keys()
    assert all(got[k] == pytest.approx(exp[k], rel=1e-12) for k in exp)
    raters = {r.movieid: r.num_raters for r in S.raters_per_item(df).collect()}
    stats = S.pair_stats(df, "item_lt_item", block_size).collect()
    assert stats and all((r.num_raters, r.num_raters2) == (raters[r.movie1], raters[r.movie2]) for r in stats)


def test_ordered_pairs_are_not_shuffled(spark, monkeypatch):
    """Ratings are sent, packed by user; no row per pair is."""
    monkeypatch.setattr(S.skew, "GRID_PAIRS", 0)
    df = spark.createDataFrame([(u, m, float(m % 5)) for u in range(300) for m in range(40)], SCHEMA)
    for out in (S.similarity(df, "item_lt_item"), S.pair_stats(df, "item_lt_item")):
        exchanges = [n for n in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in n]
        assert exchanges and not [e for e in exchanges if "movie1" in e or "movie2" in e], exchanges


def test_grid_cells_and_groups():
    from tessera.operators import skew as K
    assert K.item_groups(0) == K.item_groups(K.PAIRS_PER_CELL * 30) == K.MIN_GROUPS
    assert K.grid_cells(K.item_groups(K.PAIRS_PER_CELL * 1000)) >= 1000


def test_each_pair_of_groups_has_a_cell_of_its_own(spark):
    from tessera.operators import skew as K
    g = 9
    df = spark.range(g).selectExpr("id a").crossJoin(spark.range(g).selectExpr("id b"))
    cells = {}
    for r in df.select("a", "b", K.grid_cell(F.col("a"), F.col("b"), g).alias("p")).collect():
        cells.setdefault(r.p, set()).add((min(r.a, r.b), max(r.a, r.b)))
    assert sorted(cells) == list(range(K.grid_cells(g))) and all(len(v) == 1 for v in cells.values())


def test_ratings_are_written_once_however_many_cells(spark, monkeypatch):
    """A cell of two groups reads their columns of the staged ratings and is a task of its own;
    only cells of one group are sent packs, each rating once."""
    from tessera.operators import skew as K
    monkeypatch.setattr(S.skew, "GRID_PAIRS", 0)
    df = spark.createDataFrame([(u, m, float(m % 5 + u % 2)) for u in range(200) for m in range(40)], SCHEMA)
    out = S.similarity(df, "item_lt_item")
    plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    assert len([n for n in plan if "Exchange" in n]) == 1
    scans = [n[n.index("[") + 1:n.index("]")] for n in plan if "FileScan" in n]
    pairs = K.MIN_GROUPS * (K.MIN_GROUPS - 1) // 2
    assert len(scans) == pairs + 1 and len([s for s in scans if s.count("_g") == 2]) == pairs
    assert out.rdd.getNumPartitions() == pairs + K.MIN_GROUPS


def test_raters_go_along_with_the_ratings_of_a_grid(spark, monkeypatch):
    data = [(u, m, float((u * m) % 5 + 1)) for u in range(1, 30) for m in range(100, 100 + u)]
    data += [(3, 101, 2.0), (None, 101, 4.0), (4, None, 4.0), (7, 200, None), (8, 200, None)]
    df = spark.createDataFrame(data, SCHEMA)

    def stats(limit):
        monkeypatch.setattr(S.skew, "BROADCAST_ITEMS", limit)
        return sorted(tuple(map(repr, r)) for r in S.pair_stats(df, "item_lt_item", 20).collect())

    joined = stats(0)
    monkeypatch.setattr(S.skew, "GRID_PAIRS", 0)
    assert joined and stats(0) == stats(1_000) == joined
