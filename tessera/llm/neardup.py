"""Near-duplicate documents: fast similarity sketching, banding, verification.

1. A document becomes its set of distinct word shingles.  Documents with the
   same set form one class and go on as one row, its smallest id, so groups
   of exact copies are combined before anything is joined.
2. *Fast similarity sketch* of ``COORDS`` coordinates: in round ``i`` every
   shingle is hashed to one bin with value ``i + fraction``; a bin keeps its
   smallest value.  As soon as every bin is filled the sketch is done, after
   one or two rounds for a text of usual length.  From round ``COORDS`` on,
   round ``i`` sends all shingles to bin ``i - COORDS``, so every bin is
   filled after at most twice as many rounds, however small the set.  Two
   sketches agree in a coordinate with probability equal to the Jaccard
   similarity, with concentration bounds.
3. Banding: ``ROWS`` coordinates form a band; classes that share a band meet
   in a bucket.  A pair at similarity 0.8 meets nowhere with probability
   (1 - 0.8^5)^36 = 6e-7.
4. Buckets are not expanded into pairs.  First every member is compared with
   the bucket's smallest member, and confirmed links are joined into
   components.  Buckets whose members still lie in several components then
   compare each member outside the bucket's largest component with the
   members of other components, unless their sizes or an exact upper bound
   of their common shingles rule a link out.  After that every two members of a bucket are
   connected or have been compared, so no link between components is lost.
5. A comparison counts common shingles of the full sets.

Defined cases: a text of fewer words than a shingle has its whole sequence as
its one shingle; a text without words, or null, has an empty set and is
linked with nothing; a row with a null id is not linked and has a null
component; rows that share an id are judged by their own texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordHash, mix64, shingle_hashes, ship, stage, words
from tessera.llm.components import components

COORDS, ROWS = 180, 5
#: Shingles sketched at a time in a task; a longer text is a batch of its own.
BATCH = 400_000
BITS = 1 << 26


def _seeds(coords: int):
    return mix64(np.arange(1, 2 * coords + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(hashes, bounds, coords: int = COORDS):
    """Sketches of the sets ``hashes[bounds[i]:bounds[i+1]]`` (none empty)."""
    n, seeds, top = len(bounds) - 1, _seeds(coords), np.iinfo(np.uint64).max
    out = np.full((n, coords), top, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * coords):
        r = mix64(hashes ^ seeds[i])
        value = (np.uint64(i) << np.uint64(32)) | (r & low)
        place = ((r >> np.uint64(32)) * np.uint64(coords) >> np.uint64(32)).astype(np.int64) \
            if i < coords else i - coords
        np.minimum.at(flat, owner * coords + place, value)
        open_ = (out == top).any(axis=1)
        if not open_.any():
            break
        if open_.sum() < n // 2 or i == 0:  # go on with the sets not yet full
            keep = open_[owner]
            hashes, owner = hashes[keep], owner[keep]
    return out


def _bands(sketches):
    parts = sketches.reshape(len(sketches), COORDS // ROWS, ROWS)
    key = np.broadcast_to(mix64(np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(77)), parts.shape[:2]).copy()
    for j in range(ROWS):
        key = mix64(key ^ parts[:, :, j])
    return key.view(np.int64)


def _sets(n: int):
    """(id, text) rows -> (id, n_shingles, set_key, bands)."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        memo = WordHash()
        width = COORDS // ROWS

        def emit(ids, sets):
            full = [s for s in sets if len(s)]
            bands = np.empty((0, width), np.int64)
            if full:
                bounds = np.concatenate(([0], np.cumsum([len(s) for s in full])))
                bands = _bands(sketch(np.concatenate(full), bounds))
            counts = [width if len(s) else 0 for s in sets]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(bands.reshape(-1)))
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 lists], names=["_id", "n", "set_key", "bands"])

        for batch in batches:
            ids, sets, held, start = batch.column(0), [], 0, 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                s = np.unique(shingle_hashes(words(text), n, memo))
                sets.append(s)
                held += len(s)
                if held >= BATCH:
                    yield emit(ids.slice(start, len(sets)), sets)
                    sets, held, start = [], 0, i + 1
            if sets:
                yield emit(ids.slice(start, len(sets)), sets)
    return run


def _chosen_sets(n: int, bits_bc):
    """(id, text) -> (id, shingle hashes) for ids in the bit array."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits, memo = np.frombuffer(bits_bc.value, np.uint64), WordHash()
        for batch in batches:
            ids = batch.column(0)
            p = mix64(np.asarray(ids.to_pylist(), np.int64).view(np.uint64)) & np.uint64(BITS - 1)
            at = np.flatnonzero((bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1))
            for lo in range(0, len(at), 256):
                part = pa.array(at[lo:lo + 256], pa.int64())
                sets = [np.unique(shingle_hashes(words(t), n, memo))
                        for t in batch.column(1).take(part).to_pylist()]
                full = np.flatnonzero([len(s) for s in sets])  # an id may repeat without words
                part, sets = part.take(pa.array(full)), [sets[i] for i in full]
                if sets:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(part), pa.ListArray.from_arrays(
                            pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))), pa.int32()),
                            pa.array(np.concatenate(sets).view(np.int64)))], names=["_id", "s"])
    return run


def _id_bits(ids: DataFrame) -> bytes:
    """Ids as a hashed bit array of fixed size: a filter that lets through
    every listed id (and few others; the join that follows is exact)."""
    import pyarrow as pa

    def bits(batches):
        for batch in batches:
            p = mix64(batch.column(0).to_numpy().view(np.uint64)) & np.uint64(BITS - 1)
            w, b = (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(b.view(np.int64))], names=["w", "b"])

    rows = (ids.mapInArrow(bits, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(BITS // 64, np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.int64).view(np.uint64)
    return out.tobytes()


def _common_with_lead(batches: Iterator) -> Iterator:
    """(lead, rep, lead's set, rep's set) -> (lead, rep, bits): which shingles
    of the lead the rep has, one bit each."""
    import pyarrow as pa
    for batch in batches:
        of_lead, of_rep = batch.column(2), batch.column(3)
        bits = []
        for i in range(batch.num_rows):
            a, b = of_lead[i].values.to_numpy(), of_rep[i].values.to_numpy()
            has = np.zeros(-(-len(a) // 64) * 64, np.uint8)
            has[:len(a)] = np.isin(a, b, assume_unique=True)
            bits.append(np.packbits(has).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bits, pa.list_(pa.int64()))], names=["lead", "rep", "bits"])


def _ones(bits) -> Column:
    return F.aggregate(bits, F.lit(0), lambda total, x: total + F.bit_count(x))


def _sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``_id, s``: the full shingle sets of the listed documents."""
    ids = ids.distinct()
    bc = docs.sparkSession.sparkContext.broadcast(_id_bits(ids))
    return stage(docs.mapInArrow(_chosen_sets(n, bc), "_id long, s array<long>")
                 .join(ids, "_id", "left_semi"), "sets")


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of class representatives whose full sets are similar."""
    left = sets.select(F.col("_id").alias("u"), F.col("s").alias("su"))
    right = sets.select(F.col("_id").alias("v"), F.col("s").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    union = F.size("su") + F.size("sv") - both
    return (pairs.join(left, "u").join(right, "v").where(100 * both >= percent * union).select("u", "v"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``.

    ``key`` must be an integer column.
    """
    ship()
    src = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_t"))
    rows = stage(src.mapInArrow(_sets(n), "_id long, n long, set_key binary, bands array<long>"), "shingle-sets")
    usable = rows.where("_id is not null and n > 0")
    classes = stage(usable.groupBy("set_key").agg(F.min("_id").alias("rep"), F.first("n").alias("n"),
                                                  F.first("bands").alias("bands")), "classes")
    named = src.where(F.col("_id").isNotNull())
    banded = classes.select("rep", "n", F.explode("bands").alias("band"))
    lead = banded.groupBy("band").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last")
    members = stage(banded.join(lead.select("band", "lead"), "band").select("band", "lead", "rep", "n"), "buckets")

    def size_fits(a: str, b: str):  # |A & B| <= min, |A | B| >= max
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    # Round 1: every member against the smallest member of its bucket.
    star = (members.where("rep > lead").groupBy(F.col("lead").alias("u"), F.col("rep").alias("v"))
            .agg(F.first("n").alias("nv"))
            .join(classes.groupBy(F.col("rep").alias("u")).agg(F.min("n").alias("nu"), F.max("n").alias("mu")), "u")
            .where(size_fits("nu", "nv") | size_fits("mu", "nv")).select("u", "v"))
    star = stage(star, "star-pairs")
    ends = star.select(F.col("u").alias("_id")).unionByName(star.select(F.col("v").alias("_id")))
    links = stage(_verified(_sets_of(named, ends, n), star, percent), "links")
    comp = stage(components(links), "components")

    # Round 2: buckets that still hold several components.
    def labelled(df: DataFrame, c: DataFrame) -> DataFrame:
        return (df.join(c.withColumnRenamed("u", "rep"), "rep", "left")
                .withColumn("component", F.coalesce("component", "rep")))
    now = labelled(members, comp)
    mixed = now.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    now = stage(now.join(mixed.select("band"), "band", "left_semi"), "mixed-buckets")
    sizes = now.groupBy("band", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("c", "component")).alias("top"))
    now = now.join(largest.select("band", F.col("top.component").alias("main")), "band")
    # What two members share is at most what they share of the bucket's lead,
    # counted on bits, plus the lesser number of their other shingles that more
    # than one document holds.  The bound is exact and close: other shingles of
    # edited copies are mostly their own.
    sets = _sets_of(named, now.select(F.explode(F.array("lead", "rep")).alias("_id")), n)
    lonely = (sets.select("_id", F.explode("s").alias("h")).distinct().groupBy("h")
              .agg(F.count("*").alias("c"), F.min("_id").alias("rep")).where("c = 1")
              .groupBy("rep").agg(F.count("*").alias("lonely")))
    of_lead = (now.select("lead", "rep").distinct()
               .join(sets.select(F.col("_id").alias("lead"), F.col("s").alias("sl")), "lead")
               .join(sets.select(F.col("_id").alias("rep"), F.col("s").alias("sr")), "rep")
               .select("lead", "rep", "sl", "sr")
               .mapInArrow(_common_with_lead, "lead long, rep long, bits array<long>"))
    now = now.join(of_lead, ["lead", "rep"]).join(lonely, "rep", "left").withColumn(
        "other", F.col("n") - _ones(F.col("bits")) - F.coalesce("lonely", F.lit(0)))
    now = stage(now.select("band", "rep", "n", "bits", "other", "component", "main"), "cross-members")
    cols = ("rep", "n", "bits", "other", "component")
    stray = now.where("component <> main").select("band", *[F.col(c).alias(f"{c}_a") for c in cols])
    rest = now.select("band", *[F.col(c).alias(f"{c}_b") for c in cols])
    shared = _ones(F.zip_with("bits_a", "bits_b", lambda a, b: a.bitwiseAND(b))) + F.least("other_a", "other_b")
    may_link = size_fits("n_a", "n_b") & ((100 + percent) * shared >= percent * (F.col("n_a") + F.col("n_b")))
    cross = (stray.join(rest, (stray["band"] == rest["band"]) & (F.col("component_a") != F.col("component_b"))
                        & (F.col("rep_a") != F.col("rep_b")) & may_link)
             .select(F.least("rep_a", "rep_b").alias("u"), F.greatest("rep_a", "rep_b").alias("v")).distinct()
             .join(star, ["u", "v"], "left_anti"))
    cross = stage(cross, "cross-pairs")
    if not cross.isEmpty():
        links = stage(links.unionByName(_verified(sets, cross, percent)), "all-links")
        comp = stage(components(links), "components")

    found = labelled(classes.select("set_key", "rep"), comp).select("set_key", "component")
    out = rows.select("_id", "n", F.when(F.col("_id").isNotNull() & (F.col("n") > 0), F.col("set_key"))
                      .alias("set_key")).join(found, "set_key", "left")
    component = F.coalesce("component", "_id")
    return out.select(F.col("_id").alias(key), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))
