"""Item–item similarity by Pearson correlation over ratings.

Input ratings: ``(userid, movieid, rating)``; duplicates allowed and counted.

Two pair filters are offered:

* ``"user_lt_item"`` (default) — the filter as the original job applies
  it: a right-hand rating takes part only when its user id is smaller than
  its item id.  Both orders (a, b)/(b, a) and self pairs (a, a) survive.
* ``"item_lt_item"`` — the evidently intended ``movie1 < movie2``.

Plan shape (see ``explain``): ratings are first reduced to one row per
(user, item) — count, Σr, Σr² — with partial aggregation, so duplicated
ratings never multiply into pairs.  For ``user_lt_item`` the self-join on user
is the planned join of :mod:`tessera.operators.skew`; per-pair sums are
combinable, so the pair aggregate runs partially inside the stage that forms the
pairs and only one row per (pair, task) is shuffled.  For ``item_lt_item`` that
(done up to ``GRID_PAIRS``) is nearly a row per joined pair once there are many items: pairs are formed and
summed in the cells of a grid of item groups, which read their groups' columns of
the ratings staged by user, and what is sent or written grows with the ratings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import is_defined_number, pearson
from tessera.operators import skew
from tessera.operators.skew import (DEFAULT_BLOCK_SIZE, blocked_self_join, cell_pairs, diagonal_pairs, grid_cell,
                                    grid_cells, grouped_packs, item_group, item_groups, union_all)
from tessera.staging import drop_shuffles, stage

PAIR_FILTERS = ("user_lt_item", "item_lt_item")
SUMS = ("size", "dot_product", "rating_sum", "rating2_sum", "rating_sq", "rating2_sq")


def raters_per_item(ratings: DataFrame) -> DataFrame:
    """``(movieid, num_raters)`` — counts rating rows, not distinct users."""
    return ratings.groupBy("movieid").agg(F.count(F.lit(1)).alias("num_raters"))


def ratings_with_size(ratings: DataFrame) -> DataFrame:
    """Every rating with the number of ratings of its item.

    A partially aggregated count joined back on the item (a dimension-sized
    table: AQE broadcasts it when small); no window, so a popular item is
    never gathered into one task.
    """
    return (ratings.join(raters_per_item(ratings), on="movieid", how="inner")
                   .select("userid", "movieid", "rating", "num_raters"))


def user_item_stats(ratings: DataFrame) -> DataFrame:
    """One row per (user, item): ``cnt``, ``r_sum``, ``r_sq``."""
    return ratings.groupBy("userid", "movieid").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("rating").alias("r_sum"),
        F.sum(F.col("rating") * F.col("rating")).alias("r_sq"))


def user_degrees(ratings: DataFrame) -> DataFrame:
    """``(userid, _deg)``: about how many items each user rated, without shuffling
    a rating: counts and sketches are combined in the tasks that read."""
    return ratings.groupBy("userid").agg(F.least(
        F.count(F.lit(1)), F.approx_count_distinct("movieid")).alias("_deg"))


def _check(pair_filter: str) -> None:
    if pair_filter not in PAIR_FILTERS:
        raise ValueError(f"pair_filter must be one of {PAIR_FILTERS}, got {pair_filter!r}")


def _sum_columns() -> list[Column]:
    return [F.sum(F.col("c1") * F.col("c2")).alias("size"),
            F.sum(F.col("x") * F.col("y")).alias("dot_product"),
            F.sum(F.col("x") * F.col("c2")).alias("rating_sum"),
            F.sum(F.col("c1") * F.col("y")).alias("rating2_sum"),
            F.sum(F.col("xx") * F.col("c2")).alias("rating_sq"),
            F.sum(F.col("c1") * F.col("yy")).alias("rating2_sq")]


def _sums(pairs: DataFrame) -> DataFrame:
    """The pair sums of rows ``(movie1, c1, x, xx, movie2, c2, y, yy)``."""
    return pairs.groupBy("movie1", "movie2").agg(*_sum_columns())


def _joined_pairs(ui: DataFrame, sizes: DataFrame, pair_filter: str, block_size: int) -> DataFrame:
    """Item pairs of each user, dealt by user: ``(userid, movie1, c1, x, xx, movie2, c2, y, yy)``."""
    right_filter = (F.col("userid") < F.col("movieid")) if pair_filter == "user_lt_item" else None
    return blocked_self_join(
        ui, key="userid", item="movieid", ordered=pair_filter == "item_lt_item", sizes=sizes,
        left_cols=[F.col("movieid").alias("movie1"), F.col("cnt").alias("c1"),
                   F.col("r_sum").alias("x"), F.col("r_sq").alias("xx")],
        right_cols=[F.col("movieid").alias("movie2"), F.col("cnt").alias("c2"),
                    F.col("r_sum").alias("y"), F.col("r_sq").alias("yy")],
        right_filter=right_filter, block_size=block_size)


def _ordered_sums(ratings: DataFrame, block_size: int, raters: DataFrame | None = None) -> DataFrame:
    """Pair sums of ``movie1 < movie2``, with ``raters`` (``movieid, num_raters``) joined to both items.

    Where there are many pairs they are summed in the cells of a grid of item groups:
    ratings, with the raters of their item, are staged packed by user, and each cell
    reads what its groups hold.  Users above ``block_size`` items go through the blocked
    join; their sums per pair are staged by cell and added there.
    """
    ui, sizes = user_item_stats(ratings), user_degrees(ratings)
    hot = F.col("_deg") > block_size
    work = sizes.where(F.col("userid").isNotNull()).agg(
        F.sum(F.when(~hot, F.col("_deg") * F.col("_deg"))).alias("pairs"), F.count_if(hot).alias("hot")).first()
    pairs = (work.pairs or 0) // 2
    if pairs <= skew.GRID_PAIRS:
        sums = _sums(_joined_pairs(ui, sizes, "item_lt_item", block_size))
        return sums if raters is None else _with_raters(sums, raters)
    groups = item_groups(pairs)
    few = ui.join(sizes.where(hot), "userid", "left_anti") if work.hot else ui
    # the square of a single rating is not sent: nulls of an array compress to nothing
    few = few.withColumn("r_sq", F.when(F.col("cnt") > 1, F.col("r_sq")))
    fields, left, right = ["cnt", "r_sum", "r_sq"], [], []
    if raters is not None:
        items = raters.count()
        few = few.join(F.broadcast(raters) if items <= skew.BROADCAST_ITEMS else raters.hint("merge"), "movieid")
        fields = [*fields, "num_raters"]
        left, right = [F.col("_l.num_raters")], [F.col("_r.num_raters").alias("num_raters2")]
    packs = stage(grouped_packs(few, "userid", "movieid", fields, groups), "packed-ratings")
    if work.hot:
        many = ui.join(sizes.where(hot), "userid", "left_semi")
        more = _sums(_joined_pairs(many, sizes.where(hot), "item_lt_item", block_size))
        more = more if raters is None else _with_raters(more, raters)
        cell = grid_cell(item_group(F.col("movie1"), groups), item_group(F.col("movie2"), groups), groups)
        more = stage(more.withColumn("_p", cell).repartition(grid_cells(groups), "_p"), "pair-sums", by="_p")
    drop_shuffles(ratings.sparkSession)  # of what has been staged

    def square(side):
        return F.when(F.col(f"{side}.cnt") > 1, F.col(f"{side}.r_sq")).otherwise(
            F.col(f"{side}.r_sum") * F.col(f"{side}.r_sum"))

    pair = [F.col("_l.movieid").alias("movie1"), F.col("_l.cnt").alias("c1"), F.col("_l.r_sum").alias("x"),
            square("_l").alias("xx"), F.col("_r.movieid").alias("movie2"), F.col("_r.cnt").alias("c2"),
            F.col("_r.r_sum").alias("y"), square("_r").alias("yy"), *left, *right]
    counts = ["num_raters", "num_raters2"] if left else []
    most = [F.max(c).alias(c) for c in counts]  # one value per item
    aggregates, again = [*_sum_columns(), *most], [*[F.sum(c).alias(c) for c in SUMS], *most]
    keys, out = ["movie1", "movie2"], ["movie1", "movie2", *SUMS, *counts]
    numbers = {(a, b): n for n, (a, b) in enumerate((a, b) for a in range(groups) for b in range(a, groups))}
    same = (diagonal_pairs(packs, "movieid", fields, groups).select("_g", *pair)
            .groupBy("_g", *keys).agg(*aggregates))
    if work.hot:
        more_of = more.where(F.col("_p").isin([numbers[g, g] for g in range(groups)]))
        more_of = more_of.withColumn("_g", item_group(F.col("movie1"), groups)).drop("_p")
        same = same.unionByName(more_of).repartitionById(groups, "_g").groupBy("_g", *keys).agg(*again)
    parts = [same.select(out)]
    for a, b, pairs in cell_pairs(packs, "movieid", fields, groups):
        sums = pairs.select(pair).groupBy(keys).agg(*aggregates)
        if work.hot:
            sums = (sums.unionByName(more.where(f"_p = {numbers[a, b]}").drop("_p")).coalesce(1)
                    .groupBy(keys).agg(*again))
        parts.append(sums)
    return union_all(parts)


def _with_raters(sums: DataFrame, raters: DataFrame) -> DataFrame:
    nr1 = raters.select(F.col("movieid").alias("movie1"), F.col("num_raters"))
    nr2 = raters.select(F.col("movieid").alias("movie2"), F.col("num_raters").alias("num_raters2"))
    return sums.join(nr1, "movie1").join(nr2, "movie2").select("movie1", "movie2", *SUMS, "num_raters", "num_raters2")


def pair_sums(ratings: DataFrame, pair_filter: str = "user_lt_item",
              block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Per item pair: size, Σxy, Σx, Σy, Σx², Σy² over co-rating users.

    Equal to aggregating every joined rating pair (x from ``movie1``, y from
    ``movie2``) because each sum factors over the per-(user, item) totals.
    """
    _check(pair_filter)
    if pair_filter == "item_lt_item":
        return _ordered_sums(ratings, block_size)
    ui = user_item_stats(ratings)
    return _sums(_joined_pairs(ui, user_degrees(ratings), pair_filter, block_size))


def pair_stats(ratings: DataFrame, pair_filter: str = "user_lt_item",
               block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """:func:`pair_sums` plus the rater counts of both items.

    The original keeps ``max`` of the per-rating item sizes; within a pair
    group that is simply the size of each item, attached after the
    aggregation from the item-sized count table.  For a grid the counts go along
    with the ratings, and the pairs stay where they are.
    """
    _check(pair_filter)
    nr = raters_per_item(ratings)
    if pair_filter == "item_lt_item":
        return _ordered_sums(ratings, block_size, nr)
    return _with_raters(pair_sums(ratings, pair_filter, block_size), nr)


def correlations(sums: DataFrame) -> DataFrame:
    """``(movie1, movie2, corr)`` for every pair, NULL/NaN not yet removed."""
    return sums.select("movie1", "movie2", pearson(
        F.col("size"), F.col("dot_product"), F.col("rating_sum"), F.col("rating2_sum"),
        F.col("rating_sq"), F.col("rating2_sq")).alias("corr"))


def similarity(ratings: DataFrame, pair_filter: str = "user_lt_item",
               block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(movie1, movie2, corr)`` with undefined correlations dropped.

    Zero-variance pairs and single-rater pairs have no correlation (NaN) and
    are left out; the job never raises on them.  ±Infinity is kept.
    """
    c = correlations(pair_sums(ratings, pair_filter, block_size))
    return c.where(is_defined_number(F.col("corr")))


def similarity_lines(sim: DataFrame) -> DataFrame:
    """The text form ``movie1,movie2,corr`` (one ``value`` per pair)."""
    return sim.select(F.concat_ws(",", F.col("movie1").cast("string"), F.col("movie2").cast("string"),
                                  F.col("corr").cast("string")).alias("value"))
