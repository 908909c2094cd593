"""Skew-safe building blocks: self-joins planned from the degree histogram.

``blocked_self_join`` pairs up the items of each key (all (left item, right
item) combinations of one user, say).  A key with ``d`` items makes ``d²``
pairs, so neither rows nor keys tell how much work a task gets.  The join is
planned from the degrees instead:

* a key above ``block_size`` items is cut into blocks and its pairs into *units*
  ``(key, left block, right block)``; every other key is one unit.  No unit
  makes more than about ``block_size²`` pairs;
* with ``ordered`` only pairs with left item < right item are wanted: blocks are
  then item ranges with balanced bounds, and only units with left block <= right
  block exist (triangle blocks).  Every pair of a unit off the diagonal is
  wanted; on the diagonal the join's own condition takes each pair once;
* units are dealt over the cells of a hash, the pairs of each cell are summed
  (one aggregation of the degrees; a bounded number of cells is collected), and
  runs of cells become partitions of about ``PAIRS_PER_TASK`` pairs.  The number
  of partitions thus follows the work, whatever ``spark.sql.shuffle.partitions``
  says, and none holds much more than another.

Rows are exchanged straight to their partition (``repartitionById``), which the
join then uses as it is.  Where no key is hot and no filter tells the sides
apart, both sides are one exchange that is read twice.

``grouped_packs``, ``cell_pairs`` and ``diagonal_pairs`` are for pairs that are aggregated
by (left item, right item): a cell (item group, item group) is one task, so the pairs of
two items meet there.  Rows are packed by key into a table with a column per item group.
A cell of two groups reads their columns of that table, and cells of one group are sent
the packs of that group: no row is written once per cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BLOCK_SIZE = 2048
#: Pairs that a partition holds on average.
PAIRS_PER_TASK = 1 << 21
#: Cells per partition, and the most cells that are collected.
CELLS_PER_TASK, MAX_CELLS = 16, 1 << 20
#: Fractions of a hot key's items that are known as possible block bounds.
FRACTIONS = 1024
#: Fewest item groups of a grid, and the pairs that a cell of it makes before there are more.
MIN_GROUPS, PAIRS_PER_CELL = 8, 1 << 27
#: Pairs above which pair sums are made in a grid: below, a join of at most ``MIN_GROUPS``
#: partitions sends at most that many partial sums of a pair.
GRID_PAIRS = MIN_GROUPS * PAIRS_PER_TASK
#: Most block bounds (8 bytes each) of hot keys that are broadcast.
BROADCAST_BOUNDS = 1_000_000
#: Most rater counts of items (16 bytes each) that are broadcast.
BROADCAST_ITEMS = 1_000_000


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition ``df`` on ``cols`` into ``spark.sql.shuffle.partitions``
    partitions that AQE will not coalesce.

    AQE merges small shuffle partitions by their (compressed) bytes.  Before a
    row-heavy step — a window over tie-dense candidates, a join that fans out —
    few bytes can still mean most of the work, and merging them into one
    partition runs that work in one task.  A user-specified partition count
    is kept as is, and AQE does not split it either: hot keys must be cut into
    blocks before.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


@dataclass(frozen=True)
class PairPlan:
    """How the pairs of a self-join are dealt."""

    pairs: int            # pairs of all units
    cells: list[int]      # partition of each hash cell
    tasks: int
    heaviest: int         # pairs of the fullest partition
    hot_keys: int
    bounds: int           # blocks of all hot keys


def _blocks(degree: Column, block_size: int) -> Column:
    return F.least(F.ceil(degree / F.lit(block_size)), F.lit(FRACTIONS)).cast("int")


def _ids(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 1)


def _cell(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(key, "_lb", "_rb"), F.lit(cells)).cast("int")


def degrees(df: DataFrame, key: str) -> DataFrame:
    """``(key, _deg)``: the rows of each key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_deg"))


def plan_pairs(sizes: DataFrame, key: str, block_size: int = DEFAULT_BLOCK_SIZE, ordered: bool = False,
               pairs_per_task: int | None = None) -> PairPlan:
    """Deal the units of all keys over partitions; ``sizes`` is ``(key, _deg)``.

    Degrees may be estimates: they decide where a unit runs, not what it holds.
    """
    if block_size < 1:
        raise ValueError("block_size must be >= 1")
    per_task = pairs_per_task or PAIRS_PER_TASK
    nb = _blocks(F.col("_deg"), block_size)
    units = sizes.select(key, "_deg", nb.alias("_nb"))
    units = units.select(key, "_deg", "_nb", F.explode(_ids(F.col("_nb"))).alias("_lb"))
    first = F.col("_lb") if ordered else F.lit(0)
    units = units.select(key, "_deg", "_nb", "_lb", F.explode(F.sequence(first, F.col("_nb") - 1)).alias("_rb"))
    weight = F.ceil(F.col("_deg") / F.col("_nb")) * F.ceil(F.col("_deg") / F.col("_nb"))
    if ordered:
        weight = F.when(F.col("_lb") == F.col("_rb"), F.ceil(weight / 2)).otherwise(weight)
    wanted = 1 << 10
    while True:
        rows = (units.groupBy(_cell(key, wanted).alias("_cell"))
                .agg(F.sum(weight).alias("w"), F.count_if((F.col("_nb") > 1) & (F.col("_lb") == F.col("_rb"))).alias("b"),
                     F.count_if((F.col("_nb") > 1) & (F.col("_lb") == 0) & (F.col("_rb") == 0)).alias("h")).collect())
        total = sum(r.w for r in rows)
        need = CELLS_PER_TASK * max(1, -(-total // per_task))
        if need <= wanted or wanted == MAX_CELLS:
            break
        wanted = min(MAX_CELLS, 1 << (need - 1).bit_length())
    weights = [0] * wanted
    for r in rows:
        weights[r["_cell"]] = r.w
    tasks = max(1, min(-(-total // per_task), wanted // CELLS_PER_TASK))
    cells, done, filled = [], 0, [0] * tasks
    for w in weights:  # a cell goes where its middle falls
        at = min(tasks - 1, (2 * done + w) * tasks // (2 * total)) if total else 0
        cells.append(at)
        filled[at] += w
        done += w
    return PairPlan(total, cells, tasks, max(filled), sum(r.h for r in rows), sum(r.b for r in rows))


def _hot(df: DataFrame, sizes: DataFrame, key: str, item: str, block_size: int, ordered: bool) -> DataFrame:
    """``(key, _nb[, _bounds])`` of the keys that are cut."""
    hot = sizes.where(F.col("_deg") > block_size).select(key, _blocks(F.col("_deg"), block_size).alias("_nb"))
    if not ordered:
        return hot
    at = [i / FRACTIONS for i in range(1, FRACTIONS)]
    ranks = (df.join(hot, key, "left_semi").groupBy(key)
             .agg(F.percentile_approx(item, F.split(F.lit(",".join(map(str, at))), ",").cast("array<double>"),
                                      F.lit(4 * FRACTIONS)).alias("_ranks")))
    bounds = F.transform(F.sequence(F.lit(1), F.col("_nb") - 1),
                         lambda b: F.get("_ranks", F.floor(b * FRACTIONS / F.col("_nb")).cast("int") - 1))
    return hot.join(ranks, key).select(key, "_nb", bounds.alias("_bounds"))


def blocked_self_join(df: DataFrame, key: str, item: str,
                      left_cols: Sequence[Column], right_cols: Sequence[Column],
                      left_filter: Column | None = None,
                      right_filter: Column | None = None,
                      block_size: int = DEFAULT_BLOCK_SIZE, ordered: bool = False,
                      sizes: DataFrame | None = None, pairs_per_task: int | None = None) -> DataFrame:
    """Inner self-join of ``df`` on ``key``, planned from the degrees of the keys.

    ``left_cols``/``right_cols`` are the projections of each side (they are
    evaluated on ``df``'s columns and must have distinct output names).
    ``left_filter``/``right_filter`` are single-side predicates, applied before
    anything is sent.  The result holds ``key`` plus both projections.  With
    ``ordered`` it holds the pairs whose left item is smaller; ``df`` must then
    have one row per (key, item).  ``sizes`` may give ``(key, _deg)`` where they
    are known more cheaply than by counting ``df``.

    The degrees are counted when the plan is built (one job).  A null key
    joins nothing.
    """
    sizes = degrees(df, key) if sizes is None else sizes.where(F.col(key).isNotNull())
    plan = plan_pairs(sizes, key, block_size, ordered, pairs_per_task)
    src = df.where(F.col(key).isNotNull())
    if plan.hot_keys:
        hot = _hot(df, sizes, key, item, block_size, ordered)
        hot = F.broadcast(hot) if plan.bounds <= BROADCAST_BOUNDS else hot.hint("merge")
        src = src.join(hot, key, "left").withColumn("_nb", F.coalesce("_nb", F.lit(1)))
        block = (F.size(F.filter("_bounds", lambda b: b < F.col(item))) if ordered
                 else F.pmod(F.xxhash64(item), F.col("_nb")).cast("int"))
        src = src.withColumn("_b", F.when(F.col("_nb") == 1, F.lit(0)).otherwise(block)).drop("_bounds")
        # as left item a row is in the units (_b, j), as right item in (j, _b)
        every = _ids(F.col("_nb"))
        as_left = F.sequence(F.col("_b"), F.col("_nb") - 1) if ordered else every
        as_right = _ids(F.col("_b") + 1) if ordered else every
        left = src.withColumn("_lb", F.col("_b")).withColumn("_rb", F.explode(as_left))
        right = src.withColumn("_rb", F.col("_b")).withColumn("_lb", F.explode(as_right))
    else:  # both sides are one exchange, read twice, where the filters allow it
        left = right = src.withColumn("_lb", F.lit(0)).withColumn("_rb", F.lit(0))
    where = F.split(F.lit(",".join(map(str, plan.cells))), ",").cast("array<int>")

    def side(rows, wanted, cols, name):
        rows = rows if wanted is None else rows.where(wanted)
        dealt = rows.withColumn("_p", F.get(where, _cell(key, len(plan.cells)))).repartitionById(plan.tasks, "_p")
        return dealt.select("_p", F.col(key), "_lb", "_rb", F.col(item).alias(name), *cols)

    left, right = side(left, left_filter, left_cols, "_x"), side(right, right_filter, right_cols, "_y")
    # Sort-merge join: row estimates do not see the replication; per unit the
    # buffered side holds at most one block, and it spills.
    pairs = left.join(right.hint("merge"), on=["_p", key, "_lb", "_rb"], how="inner")
    if ordered:
        pairs = pairs.where(F.col("_x") < F.col("_y"))
    return pairs.drop("_p", "_lb", "_rb", "_x", "_y")


def item_groups(pairs: int) -> int:
    """Item groups of a grid whose cells make ``pairs`` ordered pairs in all."""
    cells = max(0, pairs) / PAIRS_PER_CELL
    return max(MIN_GROUPS, math.ceil((2 * cells) ** 0.5))


def grid_cells(groups: int) -> int:
    return groups * (groups + 1) // 2


def item_group(item: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(groups)).cast("int")


def grid_cell(a: Column, b: Column, groups: int) -> Column:
    """Number of the cell of two item groups, whichever comes first."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return (lo * groups - F.floor(lo * (lo - 1) / 2) + hi - lo).cast("int")


def grouped_packs(df: DataFrame, key: str, item: str, cols: Sequence[str], groups: int) -> DataFrame:
    """One row per key: its rows of each item group as a column ``_g0``, ``_g1``, ..,
    a struct of arrays of ``item`` and ``cols``, null where the key has none.

    ``df`` must have one row per (key, item); rows without key or item are left out.
    A key's rows are one row: hot keys belong to :func:`blocked_self_join`.
    """
    fields = [item, *cols]
    # the number of partitions is fixed: a row here makes many pairs
    src = spread(df.where(F.col(key).isNotNull() & F.col(item).isNotNull()).select(key, *fields), key)
    packs = (src.groupBy(key, item_group(F.col(item), groups).alias("_g"))
             .agg(F.collect_list(F.struct(*fields)).alias("_v"))
             # columns of equal type side by side compress better than rows
             .select(key, F.struct("_g", F.struct(*[F.col(f"_v.{c}").alias(c) for c in fields])).alias("_k"))
             .groupBy(key).agg(F.map_from_entries(F.collect_list("_k")).alias("_all")))
    return packs.select(*[F.try_element_at("_all", F.lit(g)).alias(f"_g{g}") for g in range(groups)])


def diagonal_pairs(packs: DataFrame, item: str, cols: Sequence[str], groups: int) -> DataFrame:
    """The pairs within each item group, dealt by group: ``(_g, _l, _r)``, structs of
    ``item`` and ``cols`` with ``_l.item < _r.item``; ``packs`` are :func:`grouped_packs`.

    An aggregation by ``_g`` and both items needs no exchange.
    """
    held = F.array(*[F.struct(F.lit(g).alias("_g"), F.col(f"_g{g}").alias("_v")) for g in range(groups)])
    dealt = (packs.select(F.explode(held).alias("_k")).select("_k._g", "_k._v").where("_v is not null")
             .repartitionById(groups, "_g"))
    rows = F.arrays_zip(*[F.col("_v")[c].alias(c) for c in (item, *cols)])
    return (dealt.select("_g", rows.alias("_xs")).select("_g", "_xs", F.explode_outer("_xs").alias("_l"))
            .select("_g", "_l", F.explode_outer("_xs").alias("_r")).where(F.col("_l")[item] < F.col("_r")[item]))


def cell_pairs(packs: DataFrame, item: str, cols: Sequence[str], groups: int) -> Iterator[tuple[int, int, DataFrame]]:
    """The pairs of two item groups, cell by cell and each cell in one partition:
    ``(a, b, pairs)`` with ``a < b`` and the pairs as ``(_l, _r)``, structs of ``item``
    and ``cols`` with ``_l.item < _r.item``.

    ``packs`` are :func:`grouped_packs`, best a scan of them, where only the two
    groups' columns are read.
    """
    rows = [F.arrays_zip(*[F.col(f"_g{g}")[c].alias(c) for c in (item, *cols)]) for g in range(groups)]
    # outer: packs are never empty, and no filter is inferred that zips them once more
    x, y, each = F.col("_x"), F.col("_y"), F.explode_outer("_ys").alias("_y")
    less = x[item] < y[item]
    ordered = [F.when(less, x).otherwise(y).alias("_l"), F.when(less, y).otherwise(x).alias("_r")]
    for a in range(groups):
        for b in range(a + 1, groups):
            held = packs.where(f"_g{a} is not null and _g{b} is not null").coalesce(1)
            yield a, b, held.select(F.explode_outer(rows[a]).alias("_x"), rows[b].alias("_ys")).select("_x", each).select(ordered)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """The union of many dataframes; analysed a few at a time."""
    while len(parts) > 1:
        parts = [reduce(DataFrame.union, parts[i:i + 8]) for i in range(0, len(parts), 8)]
    return parts[0]
