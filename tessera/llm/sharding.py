"""Histogram sort into shards of near-equal bytes, in DataFrame operations only.

Documents are ordered by *(hash of the text, id, row)*: equal texts are
neighbours, and a group of copies larger than a shard can still be cut
between two rows.  Shard boundaries are found as in histogram sorting:

1. a compact row per document (key, size, digest) is staged once;
2. each round counts the exact bytes in equal cells of the interval that
   still brackets each unmet boundary (one aggregation, at most boundaries x
   ``PROBES`` counts to the driver), and narrows the interval to the cell
   that holds the target;
3. a boundary is met when the bytes below a probe are within ``tolerance``
   of a shard from its target, or when it lies between two single rows;
4. all rows are then exchanged once, by shard and sub-range, and numbered.

An interval of one hash value is refined on the id, and one id on the row
number, so hot copies, repeated rows and null ids are cut as well.

Law ``bytes``: every shard's bytes differ from the mean by at most the
tolerance (twice, once per end) or the size of one row.  A null text has
size 8 and digest 0; a null id sorts first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stage

PROBES = 512
#: Rows of one shard that one task sorts and numbers at most, on average.
ROWS_PER_TASK = 4_000_000
KEYS = ("_h", "_d", "_r")


def _between(prefix: tuple[int, ...], lo: int, hi: int) -> Column:
    """Rows whose leading keys equal ``prefix`` and whose next key is in [lo, hi]."""
    cond = F.col(KEYS[len(prefix)]).between(lo, hi)
    for name, value in zip(KEYS, prefix, strict=False):
        cond = cond & (F.col(name) == F.lit(value))
    return cond


def _at_or_above(boundary: tuple[int, ...]) -> Column:
    """Lexicographic ``key >= boundary`` (a prefix of the key columns)."""
    *head, last = boundary
    cond = F.col(KEYS[len(head)]) >= F.lit(last)
    for i in reversed(range(len(head))):
        cond = (F.col(KEYS[i]) > F.lit(head[i])) | ((F.col(KEYS[i]) == F.lit(head[i])) & cond)
    return cond


def _search(values: list[Column], cuts: list[Column]) -> Column:
    """``values[i]`` for rows at or above the first ``i`` ascending cuts: a
    balanced tree, so that thousands of cuts nest a dozen levels deep."""
    if not cuts:
        return values[0]
    mid = len(cuts) // 2
    return F.when(cuts[mid], _search(values[mid + 1:], cuts[mid + 1:])).otherwise(
        _search(values[:mid + 1], cuts[:mid]))


def splitters(rows: DataFrame, parts: int, tolerance: float) -> list[tuple[int, ...] | None]:
    """Lower boundary of parts 1 .. parts-1 (None: past the last row).

    ``rows`` holds the key columns and ``size``.  Targets are met within
    ``tolerance`` parts, or as close as a boundary between rows allows.
    """
    total, lo, hi = rows.agg(F.sum("size"), F.min("_h"), F.max("_h")).first()
    if total is None:
        return [None] * (parts - 1)
    slack = tolerance * total / parts
    # boundary number -> (prefix, lo, hi, bytes below lo)
    open_, done = {i: ((), lo, hi, 0) for i in range(1, parts)}, {}
    while open_:
        spans = sorted({(p, a, b) for p, a, b, _ in open_.values()})
        # spans are disjoint, so a row can only lie in the last one that starts at or below it
        spans.sort(key=lambda s: (*s[0], s[1]))
        number = {span: j for j, span in enumerate(spans)}
        none = F.lit(None).cast("struct<i:int,c:bigint>")
        place = _search([none] + [F.when(_between(p, a, b), F.struct(
            F.lit(j).alias("i"), F.expr(f"({KEYS[len(p)]} - ({a}L)) div {(b - a) // PROBES + 1}L").alias("c")))
            for j, (p, a, b) in enumerate(spans)], [_at_or_above((*p, a)) for p, a, _ in spans])
        nxt = [F.min(k).alias(f"min{k}") for k in KEYS] + [F.max(k).alias(f"max{k}") for k in KEYS]
        counts = (rows.withColumn("_p", place).where("_p is not null")
                  .withColumns({"_i": F.col("_p.i"), "_c": F.col("_p.c")}).groupBy("_i", "_c").agg(F.sum("size").alias("size"), *nxt)
                  .orderBy("_i", "_c").collect())  # at most boundaries x PROBES rows
        cells: dict[int, list] = {}
        for r in counts:
            cells.setdefault(r["_i"], []).append(r)
        for i, (p, a, b, base) in list(open_.items()):
            target, key = i * total / parts, KEYS[len(p)]
            run = base
            for r in cells[number[(p, a, b)]]:
                if run + r["size"] > target:
                    break
                run += r["size"]
            else:  # target at the end of the interval: boundary above it
                done[i] = (*p, b + 1)
                del open_[i]
                continue
            first, last = r[f"min{key}"], r[f"max{key}"]
            over = run + r["size"] - target
            if target - run <= slack:
                done[i] = (*p, first)
            elif over <= slack:
                done[i] = (*p, last + 1)
            elif first < last:
                open_[i] = (p, first, last, run)
                continue
            elif len(p) + 1 < len(KEYS):
                deeper = KEYS[len(p) + 1]
                open_[i] = ((*p, first), r[f"min{deeper}"], r[f"max{deeper}"], run)
                continue
            else:  # a single row holds the target: the nearer side of it
                done[i] = (*p, first if target - run <= over else last + 1)
            del open_[i]
    return [done[i] for i in range(1, parts)]


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text",
          tolerance: float = 0.002) -> DataFrame:
    """One row per input row: ``key, size, text_crc32, law, shard, slot,
    grown_shard``; ``slot`` counts from 0 in key order within a shard."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    ident = F.xxhash64(F.col(key)) if docs.schema[key].dataType.typeName() == "string" \
        else F.col(key).cast("long")
    rows = stage(docs.select(
        F.col(key).alias("_key"), size.alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("_h"),
        F.greatest(F.coalesce(ident, F.lit(-(1 << 61))), F.lit(-(1 << 61))).alias("_d"),
        F.monotonically_increasing_id().alias("_r")), "shard-keys")
    n = rows.count()
    per_shard = max(1, -(-n // (shards * ROWS_PER_TASK)))
    cuts = splitters(rows, shards * per_shard, tolerance)
    above = [_at_or_above(c) for c in sorted(c for c in cuts if c is not None)]
    cell = _search([F.lit(i) for i in range(len(above) + 1)], above)
    # The one exchange: rows go to their cell, are sorted and numbered there.
    tasks = max(shards * per_shard, min(partitions(docs.sparkSession), 4 * shards * per_shard))
    placed = stage(rows.withColumn("_cell", cell).repartition(tasks, "_cell")
                   .sortWithinPartitions("_cell", *KEYS)
                   .withColumn("_n", F.monotonically_increasing_id()), "shard-rows")
    cells = placed.groupBy("_cell").agg(F.min("_n").alias("_n0"), F.count("*").alias("_size"))
    cells = cells.withColumn("shard", F.expr(f"_cell div {per_shard}").cast("int"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    return placed.join(cells.select("_cell", "_n0", "_base", "shard"), "_cell").select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_base") + F.col("_n") - F.col("_n0")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id") -> None:
    """Write the documents themselves, one folder per shard, in slot order.

    ``key`` must name each row once here, as texts join their slot by it.
    """
    place = shard(docs, shards, key).select(F.col(key), "shard", "slot")
    joined = docs.drop("shard", "slot").join(place, key)
    (joined.repartition(partitions(docs.sparkSession), "shard", F.expr("slot div 100000"))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
