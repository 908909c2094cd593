"""Per-user predictions from item similarities.

Pipeline (each step is also exposed on its own):

1. ``liked_items``        — ratings with ``rating > 4``.
2. ``similar_per_user``   — liked item × similarity rows whose first item it is.
3. ``drop_self_pairs``    — ``movieid1 <> movieid2``.
4. candidates             — ``"seen"`` (default; what the original script
   computes: its outer join keeps only items the user *has* rated, one row
   per matching rating) or ``"unseen"`` (the intended anti join).
5. ``best_candidates``    — per (user, movieid1) the candidates with the
   highest correlation, ties kept (``rank() = 1``), NULL correlations out.
6. ``predictions``        — distinct (userid, moviename) of the best.

``narrow=True`` (default) reads correlations through a FLOAT column like
the original similarity table, which creates extra ties.

Scale: the "seen" best-candidate path never materialises
liked × similarity.  Each liked item takes its user's rated items, packed in
arrays, to the partition that holds its similar items, where the pairs are
looked up and ranked (:func:`_dealt_candidates`); duplicate ratings are carried
as a multiplicity.  Rows are expanded back to their multiplicity only at the end
(in spread chunks), so the multiset result is unchanged.  The "unseen" path compares bitmaps of the correlation levels of an
item with bitmaps of the items a user has rated (:func:`_unseen_pairs`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.stats import narrow_to_float
from tessera.operators import bitmaps as B
from tessera.operators.skew import DEFAULT_BLOCK_SIZE, spread
from tessera.operators.similarity import user_degrees
from tessera.staging import drop_shuffles, stage

CANDIDATE_MODES = ("seen", "unseen")


# ---------------------------------------------------------------- inputs ---

def similarity_table(sim: DataFrame, narrow: bool = True) -> DataFrame:
    """``(movieid1, movieid2, correlation_factor)`` from ``(movie1, movie2, corr)``."""
    corr = narrow_to_float(F.col("corr")) if narrow else F.col("corr").cast("double")
    return sim.select(F.col("movie1").alias("movieid1"), F.col("movie2").alias("movieid2"),
                      corr.alias("correlation_factor"))


def liked_items(ratings: DataFrame) -> DataFrame:
    """``(userid, movieid)`` of ratings strictly above 4."""
    return ratings.where(F.col("rating") > 4).select("userid", "movieid")


# ------------------------------------------------------- step operators ---

def similar_per_user(ratings: DataFrame, sim_table: DataFrame) -> DataFrame:
    liked = liked_items(ratings)
    return (liked.join(sim_table, liked.movieid == sim_table.movieid1)
                 .select("userid", "movieid1", "movieid2", "correlation_factor"))


def drop_self_pairs(df: DataFrame) -> DataFrame:
    return df.where(F.col("movieid1") != F.col("movieid2"))


def _rated(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("userid").alias("r_userid"), F.col("movieid").alias("r_movieid"),
                          "rating")


def candidates_outer(spu: DataFrame, ratings: DataFrame) -> DataFrame:
    """Left outer join of per-user similar items to the user's ratings."""
    r = _rated(ratings)
    cond = (spu.userid == r.r_userid) & (spu.movieid2 == r.r_movieid)
    return spu.join(r, cond, "left").select("userid", "movieid1", "movieid2",
                                            "correlation_factor", "rating")


def candidates_seen(spu: DataFrame, ratings: DataFrame) -> DataFrame:
    """The outer join filtered on ``rating is not null`` — items already rated."""
    return candidates_outer(spu, ratings).where(F.col("rating").isNotNull())


def candidates_unseen(spu: DataFrame, ratings: DataFrame) -> DataFrame:
    """Items the user has not rated (anti join on user and item)."""
    r = _rated(ratings).where(F.col("rating").isNotNull())
    cond = (spu.userid == r.r_userid) & (spu.movieid2 == r.r_movieid)
    return spu.join(r, cond, "left_anti").withColumn("rating", F.lit(None).cast("double"))


def max_correlation(cands: DataFrame) -> DataFrame:
    """``(userid, movieid1, correlation)`` = max correlation per group."""
    return cands.groupBy("userid", "movieid1").agg(
        F.max("correlation_factor").alias("correlation"))


def best_candidates(cands: DataFrame) -> DataFrame:
    """Arg-max with ties: rows whose correlation equals the group maximum."""
    w = Window.partitionBy("userid", "movieid1").orderBy(F.col("correlation_factor").desc_nulls_last())
    return (cands.where(F.col("correlation_factor").isNotNull())
                 .withColumn("_rk", F.rank().over(w))
                 .where(F.col("_rk") == 1)
                 .select("userid", "movieid1", "movieid2",
                         F.col("correlation_factor").cast("double").alias("correlation")))


def best_candidates_joinback(cands: DataFrame) -> DataFrame:
    """The same result in the group-then-join-back form (cross-check)."""
    # said before the split, so that both branches read one exchange
    for c in ("userid", "movieid1", "correlation_factor"):
        cands = cands.where(F.col(c).isNotNull())
    mx = max_correlation(cands).withColumnRenamed("userid", "m_userid") \
                               .withColumnRenamed("movieid1", "m_movieid1")
    cond = ((cands.userid == mx.m_userid) & (cands.movieid1 == mx.m_movieid1)
            & (cands.correlation_factor == mx.correlation))
    return cands.join(mx, cond).select("userid", "movieid1", "movieid2",
                                       F.col("correlation").cast("double").alias("correlation"))


def predictions_from_best(best: DataFrame, movies: DataFrame) -> DataFrame:
    """Distinct ``(userid, moviename)`` of the best candidates."""
    b = best.select("userid", "movieid2").distinct()
    return (b.join(movies, b.movieid2 == movies.movieid)
             .select("userid", "moviename").distinct())


# --------------------------------------------------- scalable pipeline ---

def _user_item_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userid", "movieid").agg(
        F.count("rating").alias("rated_cnt"),
        F.count_if(F.col("rating") > 4).alias("liked_cnt"))


def _keyed(ratings: DataFrame) -> DataFrame:
    """Ratings that can join; said at the source, so that all branches share one exchange."""
    return ratings.where(F.col("userid").isNotNull() & F.col("movieid").isNotNull())


EXPAND_CHUNK = 4096


def _chunked(df: DataFrame, mult: str, into: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Rows cut into chunks ``_chunk`` of at most ``chunk`` of their ``mult`` copies, counted in ``into``."""
    m = F.col(mult)
    df = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((m - 1) / chunk).cast("long"))))
    return df.withColumn(into, F.least(F.lit(chunk).cast("long"), m - F.col("_chunk") * chunk))


def _repeated(chunked: DataFrame, cols: list[str]) -> DataFrame:
    return chunked.withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(*cols)


def _expand(df: DataFrame, mult: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Repeat each row ``mult`` times (restores multiset semantics).

    A row is first cut into chunks of at most ``chunk`` copies and the chunk
    rows are hash-spread over the cluster, so a huge multiplicity (one
    duplicated key holding a large share of the input) is expanded by many
    tasks; the shuffle carries one row per chunk, not the copies.
    """
    cols = [c for c in df.columns if c != mult]
    return _repeated(spread(_chunked(df, mult, "_n", chunk), *cols, "_chunk"), cols)


#: Pairs of rated items for which a partition of the seen candidates is made.
PAIRS_PER_PART = 1 << 22
#: Users joined to one copy of an item's similar items.
USERS_PER_COPY = 50_000


def _popular(liked: DataFrame, users_per_copy: int) -> DataFrame:
    """``(movieid1, _copies)`` of the items that more users like; few, as each has many rows."""
    return (liked.groupBy("movieid1").agg(F.ceil(F.count("*") / users_per_copy).cast("int").alias("_copies"))
            .where(F.col("_copies") > 1))


def _copied(df: DataFrame, popular: DataFrame) -> DataFrame:
    """``df`` with the ``_copies`` of each row's ``movieid1``."""
    return df.join(F.broadcast(popular), "movieid1", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))


def _dealt_candidates(ratings: DataFrame, sim_table: DataFrame, liked: DataFrame, rated: DataFrame,
                      block_size: int, users_per_copy: int = USERS_PER_COPY) -> DataFrame:
    """Each liked item joined to the user's rated items that are similar to it.

    ``liked`` is ``(userid, movieid1, ...)``, ``rated`` ``(userid, movieid2, ...)``;
    the result holds their columns, ``correlation_factor`` and ``_p``: the
    candidates of a (user, liked item) are all in the partition ``_p``.

    A liked item takes its user's rated items along, packed in arrays of at most
    ``block_size``, to the partition that holds the similar items of that item: no
    pair is sent or sorted.  Items that many users like are copied, and their users
    dealt over the copies.  There are partitions in proportion to the pairs of
    items that users rated, which bound the similarity rows, too; their share is
    what a task looks the pairs up in.
    """
    work = user_degrees(ratings).agg(F.sum(F.col("_deg") * F.col("_deg"))).first()[0] or 0
    drop_shuffles(ratings.sparkSession)  # of the degrees
    parts = max(int(sim_table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-work // PAIRS_PER_PART))
    popular = _popular(liked, users_per_copy)

    def at(copy):
        return F.pmod(F.xxhash64("movieid1", copy), F.lit(parts)).cast("int")

    fields = [c for c in rated.columns if c != "userid"]
    # a user of very many items is cut into packs of about block_size
    pack = F.floor((F.row_number().over(Window.partitionBy("userid").orderBy("movieid2")) - 1) / block_size)
    packs = (rated.withColumn("_b", pack).groupBy("userid", "_b").agg(F.collect_list(F.struct(*fields)).alias("_v"))
             .select("userid", F.struct(*[F.col(f"_v.{c}").alias(c) for c in fields]).alias("_v")))
    asked = _copied(liked.join(packs.hint("merge"), "userid"), popular)
    asked = (asked.withColumn("_p", at(F.pmod(F.xxhash64("userid"), F.col("_copies")).cast("int"))).drop("_copies")
             .repartitionById(parts, "_p"))
    pairs = (asked.withColumn("_v", F.explode(F.arrays_zip(*[F.col("_v")[c].alias(c) for c in fields])))
             .select(*[c for c in asked.columns if c != "_v"], "_v.*")
             .where(F.col("movieid1") != F.col("movieid2")))
    offered = _copied(drop_self_pairs(sim_table), popular)
    # two copies may fall into one partition
    offered = offered.select("movieid1", "movieid2", "correlation_factor", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.col("_copies") - 1), at))).alias("_p")).repartitionById(parts, "_p")
    return pairs.join(offered.hint("shuffle_hash"), on=["_p", "movieid1", "movieid2"])


def _seen_pairs(ratings: DataFrame, sim_table: DataFrame, block_size: int) -> DataFrame:
    """(_p, userid, movieid1, movieid2, correlation_factor, mult) of seen candidates."""
    ui = _user_item_counts(_keyed(ratings)).where(F.col("rated_cnt") > 0)
    # both counts on both sides: one aggregation, one exchange, read twice
    liked = ui.where(F.col("liked_cnt") > 0).select("userid", F.col("movieid").alias("movieid1"), "liked_cnt")
    rated = ui.where(F.col("liked_cnt") >= 0).select("userid", F.col("movieid").alias("movieid2"), "rated_cnt")
    return (_dealt_candidates(ratings, sim_table, liked, rated, block_size)
            .select("_p", "userid", "movieid1", "movieid2", "correlation_factor",
                    (F.col("liked_cnt") * F.col("rated_cnt")).alias("mult")))


def seen_candidates(ratings: DataFrame, sim_table: DataFrame,
                    block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Same rows as ``candidates_seen(drop_self_pairs(similar_per_user(...)))``.

    Built from each user's (liked item, rated items) packs of
    ``(user, item, rating) → count`` rows, joined to the similarity table on
    ``(movieid1, movieid2)``; one output row per (liked rating, rated rating)
    combination, expanded only at the end.
    """
    urr = (_keyed(ratings).where(F.col("rating").isNotNull())
                  .groupBy("userid", "movieid", "rating").agg(F.count(F.lit(1)).alias("cnt")))
    liked = urr.where(F.col("rating") > 4).select("userid", F.col("movieid").alias("movieid1"), F.col("cnt").alias("lc"))
    rated = urr.select("userid", F.col("movieid").alias("movieid2"), "rating", F.col("cnt").alias("rc"))
    out = (_dealt_candidates(ratings, sim_table, liked, rated, block_size)
           .select("userid", "movieid1", "movieid2", "correlation_factor", "rating",
                   (F.col("lc") * F.col("rc")).alias("mult")))
    return _expand(out, "mult")


def level_bitmaps(sim_table: DataFrame) -> DataFrame:
    """``(movieid1, _bucket, _levels, _rank)``: the similar items of an item, bucket
    by bucket, as bitmaps of the levels of equal correlation, best level first.

    ``_levels`` holds ``(corr, words)`` with ``words`` of ``(cnt, word, bits)``:
    items of that word, which the table repeats ``cnt`` times; 1,024 levels at
    most.  ``_rank`` ranks an item's buckets by their best level.  Of an item's
    several correlations to another only the highest can be the best unseen one,
    so the rest is left out.
    """
    key = ["movieid1", "_bucket"]
    src = (drop_self_pairs(sim_table).where(F.col("correlation_factor").isNotNull())
           .withColumn("_bucket", B.bucket("movieid2")))
    # by item alone: its buckets are ranked where they are made
    pairs = (spread(src, "movieid1")
             .groupBy(*key, "movieid2", "correlation_factor").agg(F.count("*").alias("cnt"))
             .groupBy(*key, "movieid2").agg(F.max(F.struct(F.col("correlation_factor").alias("corr"), "cnt")).alias("_top")))
    words = (pairs.groupBy(*key, F.col("_top.corr").alias("corr"), F.col("_top.cnt").alias("cnt"),
                           B.word("movieid2").alias("word")).agg(F.bit_or(B.bit("movieid2")).alias("bits")))
    levels = words.groupBy(*key, "corr").agg(F.collect_list(F.struct("cnt", "word", "bits")).alias("words"))
    buckets = levels.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("corr", "words")), asc=False).alias("_levels"))
    best = Window.partitionBy("movieid1").orderBy(F.desc(F.col("_levels")[0]["corr"]))
    return buckets.withColumn("_rank", F.rank().over(best))


def unseen_bitmaps(ratings: DataFrame, sim_table: DataFrame, users_per_copy: int = USERS_PER_COPY,
                   chunk: int | None = None) -> DataFrame:
    """The best unseen candidates of each (user, liked item) as bitmaps:
    ``(userid, movieid1, _bucket, liked_cnt, correlation_factor, _rest)`` with
    ``_rest`` an array of ``(cnt, word, bits)``.

    An item's similar items fall into levels of equal correlation.  The best
    unseen candidates of (user, item) are what the user has not rated of the
    first level that the user has not rated in full.  Both sides are bitmaps:
    in a bucket the first level with a bit that the user's bitmap lacks is found
    by ``level & ~rated``, and the best such level over the buckets wins.  Liked
    and rated items are never paired, and items become rows only in the result.

    A bucket in which a user rated ``d`` items is compared with ``d + 1`` levels
    at most, and a user with ratings in ``k`` buckets with the ``k + 1`` best buckets
    of an item, ties included.  Buckets are rows, so a user of very many ratings
    is split by bucket.  Items that many users like are copied, and their users
    dealt over the copies.  The level bitmaps are staged, as they are read twice, so
    the similarity is computed once.  With ``chunk`` a liked item that a user rated
    more than ``chunk`` times is several rows, ranked in several tasks.
    """
    levels = stage(level_bitmaps(sim_table), "level-bitmaps")
    drop_shuffles(ratings.sparkSession)  # of what has been staged
    ui = _user_item_counts(ratings)
    # both counts in every branch, and what the joins of a branch would filter: one exchange for
    # both uses of what is rated (here without null keys, which match nothing), one for both of what is liked
    rated = (ui.where(F.col("userid").isNotNull() & F.col("movieid").isNotNull()
                      & (F.col("rated_cnt") > 0) & (F.col("liked_cnt") >= 0))
             .groupBy("userid", B.bucket("movieid").alias("_bucket")).agg(B.bitmap("movieid").alias("_rated"))
             .where(F.col("_bucket").isNotNull()))
    buckets = rated.groupBy("userid").agg(F.count("*").alias("_k"))
    liked = (ui.where(F.col("movieid").isNotNull() & (F.col("liked_cnt") > 0) & (F.col("rated_cnt") > 0))
             .select("userid", F.col("movieid").alias("movieid1"), F.col("liked_cnt")))
    key = ["userid", "movieid1"]
    offered = _copied(levels, _popular(liked, users_per_copy))
    if chunk:
        liked, key = _chunked(liked, "liked_cnt", "liked_cnt", chunk), [*key, "_chunk"]
    asked = (liked.join(buckets, "userid", "left")
             .join(offered.select("movieid1", "_bucket", "_rank", "_copies"), "movieid1")
             .where(F.col("_rank") <= F.coalesce("_k", F.lit(0)) + 1)
             .join(rated, ["userid", "_bucket"], "left")
             .select(*key, "_bucket", "liked_cnt", "_rated",
                     F.pmod(F.xxhash64("userid"), F.col("_copies")).cast("int").alias("_copy")))
    dealt = offered.select("movieid1", "_bucket", "_levels",
                           F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    on = ["movieid1", "_bucket", "_copy"]
    both = spread(asked, *on).join(spread(dealt, *on).hint("merge"), on).withColumn("_d", B.size("_rated"))
    first = F.expr("""if(_rated is null, _levels[0], get(filter(slice(_levels, 1, cast(_d as int) + 1),
        l -> exists(l.words, e -> (e.bits & ~_rated[e.word]) != 0)), 0))""")
    found = both.select(*key, "_bucket", "liked_cnt", "_rated", first.alias("_first"))
    rest = F.expr("transform(_first.words, e -> struct(e.cnt, e.word, "
                  "if(_rated is null, e.bits, e.bits & ~_rated[e.word]) as bits))")
    found = found.where("_first is not null").select(
        *key, "_bucket", "liked_cnt", F.col("_first.corr").alias("correlation_factor"),
        rest.alias("_rest"))
    order = Window.partitionBy(*key).orderBy(F.desc("correlation_factor"))
    return spread(found, *key).withColumn("_rk", F.rank().over(order)).where(F.col("_rk") == 1).drop("_rk")


def _items_of(words: DataFrame, kind, *cols) -> DataFrame:
    """A row per item of rows ``(_bucket, word, bits)``, as ``movieid2``."""
    return (words.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(63))))
            .where(F.expr("shiftrightunsigned(bits, _i) & 1 = 1"))
            .select(*cols, F.expr("shiftleft(_bucket, 10) + word * 64 + _i").cast(kind).alias("movieid2")))


def _unseen_pairs(ratings: DataFrame, sim_table: DataFrame, users_per_copy: int = USERS_PER_COPY,
                  chunk: int | None = None) -> DataFrame:
    """(userid, movieid1, movieid2, correlation_factor, mult) of the best unseen candidates."""
    best = unseen_bitmaps(ratings, sim_table, users_per_copy, chunk).select("*", F.inline("_rest"))
    best = best.withColumn("mult", F.col("liked_cnt") * F.col("cnt"))
    out = _items_of(best, sim_table.schema["movieid2"].dataType, "userid", "movieid1", "correlation_factor", "mult")
    return out.select("userid", "movieid1", "movieid2", "correlation_factor", "mult")


def max_seen_correlation(ratings: DataFrame, sim_table: DataFrame,
                         block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """:func:`max_correlation` of the already-rated candidates, from the blocked
    pairs: repeated rows do not change a maximum."""
    pairs = _seen_pairs(ratings, sim_table, block_size)
    return (pairs.groupBy("_p", "userid", "movieid1").agg(F.max("correlation_factor").alias("correlation")).drop("_p"))


def best_candidate_groups(ratings: DataFrame, sim: DataFrame, candidates: str = "seen",
                          narrow: bool = True, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Best candidates with a ``mult`` column instead of repeated rows."""
    if candidates not in CANDIDATE_MODES:
        raise ValueError(f"candidates must be one of {CANDIDATE_MODES}, got {candidates!r}")
    st = similarity_table(sim, narrow)
    if candidates == "unseen":
        return _unseen_pairs(ratings, st).withColumnRenamed("correlation_factor", "correlation")
    cands = _seen_pairs(ratings, st, block_size)
    # the candidates of a group are in one partition already
    w = Window.partitionBy("_p", "userid", "movieid1").orderBy(F.col("correlation_factor").desc())
    return (cands.where(F.col("correlation_factor").isNotNull())
                 .withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1)
                 .select("userid", "movieid1", "movieid2",
                         F.col("correlation_factor").alias("correlation"), "mult"))


def best_candidates_for(ratings: DataFrame, sim: DataFrame, candidates: str = "seen",
                        narrow: bool = True, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(userid, movieid1, movieid2, correlation)``, one row per original row.

    Unseen candidates repeat as often as the user rated the liked item (and the
    table the pair).  Their chunks are dealt over the tasks before they are ranked,
    so the rows, many times the bitmaps, are spelled out where those are and never sent.
    """
    if candidates == "unseen":
        pairs = _unseen_pairs(ratings, similarity_table(sim, narrow), chunk=EXPAND_CHUNK)
        pairs = pairs.withColumnRenamed("correlation_factor", "correlation")
        return _repeated(_chunked(pairs, "mult", "_n"), [c for c in pairs.columns if c != "mult"])
    return _expand(best_candidate_groups(ratings, sim, candidates, narrow, block_size), "mult")


def predictions(ratings: DataFrame, sim: DataFrame, movies: DataFrame, candidates: str = "seen",
                narrow: bool = True, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Distinct ``(userid, moviename)``; multiplicities are irrelevant here."""
    if candidates == "unseen":  # a user's candidates are united as bitmaps, before they become rows
        st = similarity_table(sim, narrow)
        words = (unseen_bitmaps(ratings, st).select("userid", "_bucket", F.inline("_rest"))
                 .groupBy("userid", "_bucket", "word").agg(F.bit_or("bits").alias("bits")))
        # by user: once a name is joined from a broadcast, the distinct rows need no exchange
        items = _items_of(spread(words, "userid"), st.schema["movieid2"].dataType, "userid")
        return (items.join(movies, items.movieid2 == movies.movieid).select("userid", "moviename").distinct())
    best = best_candidate_groups(ratings, sim, candidates, narrow, block_size)
    return predictions_from_best(best, movies)
