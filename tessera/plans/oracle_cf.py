"""Independent DuckDB SQL for the collaborative-filtering queries.

Written straight from the semantics (raw rating pairs, join-back arg-max),
not from the Spark plans, so that a wrong rewrite on the Spark side shows
up as a mismatch.
"""

from __future__ import annotations

RT = ("rt as (select o_custkey as userid, l_suppkey as movieid, "
      "cast(ceil(l_quantity/10) as double) as rating "
      "from lineitem join orders on l_orderkey = o_orderkey)")

_FILTERS = {"user_lt_item": "a.userid < b.movieid", "item_lt_item": "a.movieid < b.movieid"}


def st(pair_filter: str) -> str:
    return (f"st as (select a.movieid as movie1, b.movieid as movie2, count(*) as size, "
            f"sum(a.rating*b.rating) as dot_product, sum(a.rating) as rating_sum, "
            f"sum(b.rating) as rating2_sum, sum(a.rating*a.rating) as rating_sq, "
            f"sum(b.rating*b.rating) as rating2_sq "
            f"from rt a join rt b on a.userid = b.userid where {_FILTERS[pair_filter]} "
            f"group by a.movieid, b.movieid)")


_NUM = "(size*dot_product - rating_sum*rating2_sum)"
_DEN = "(sqrt(size*rating_sq - rating_sum*rating_sum) * sqrt(size*rating2_sq - rating2_sum*rating2_sum))"
CORR = (f"case when {_DEN} <> 0 then {_NUM} / {_DEN} when {_NUM} > 0 then 'inf'::double "
        f"when {_NUM} < 0 then '-inf'::double else 'nan'::double end")


def sim(pair_filter: str) -> str:
    return (f"{RT}, {st(pair_filter)}, "
            f"c as (select movie1, movie2, {CORR} as corr from st), "
            f"sim as (select * from c where corr is not null and not isnan(corr))")


def stab(narrow: bool) -> str:
    corr = "cast(cast(corr as float) as double)" if narrow else "corr"
    return (f"stab as (select movie1 as movieid1, movie2 as movieid2, {corr} as correlation_factor "
            f"from sim)")


def chain(narrow: bool = True, pair_filter: str = "user_lt_item", candidates: str = "seen") -> str:
    base = (f"{sim(pair_filter)}, {stab(narrow)}, "
            "spu as (select l.userid, s.movieid1, s.movieid2, s.correlation_factor "
            "from (select userid, movieid from rt where rating > 4) l "
            "join stab s on l.movieid = s.movieid1), "
            "sp as (select * from spu where movieid1 <> movieid2), "
            "co as (select sp.userid, sp.movieid1, sp.movieid2, sp.correlation_factor, r.rating "
            "from sp left join rt r on sp.userid = r.userid and sp.movieid2 = r.movieid), ")
    if candidates == "seen":
        cd = "cd as (select * from co where rating is not null), "
    else:
        cd = ("cd as (select sp.*, cast(null as double) as rating from sp where not exists "
              "(select 1 from rt r where r.userid = sp.userid and r.movieid = sp.movieid2 "
              "and r.rating is not null)), ")
    return base + cd + (
        "mx as (select userid, movieid1, max(correlation_factor) as correlation from cd "
        "group by userid, movieid1), "
        "best as (select c.userid, c.movieid1, c.movieid2, m.correlation from cd c join mx m "
        "on c.userid = m.userid and c.movieid1 = m.movieid1 and c.correlation_factor = m.correlation)")


def predictions(**kw) -> str:
    return (f"with {chain(**kw)} select distinct b.userid, s.s_name as moviename "
            f"from best b join supplier s on b.movieid2 = s.s_suppkey")


ORACLE = {
    "raters_per_item": f"with {RT} select movieid, count(*) as num_raters from rt group by movieid",
    "ratings_with_size": (f"with {RT} select r.userid, r.movieid, r.rating, n.num_raters from rt r join "
                          "(select movieid, count(*) as num_raters from rt group by movieid) n "
                          "on r.movieid = n.movieid"),
    "pair_stats": (f"with {RT}, {st('user_lt_item')}, "
                   "nr as (select movieid, count(*) as num_raters from rt group by movieid) "
                   "select st.*, a.num_raters, b.num_raters as num_raters2 from st "
                   "join nr a on st.movie1 = a.movieid join nr b on st.movie2 = b.movieid"),
    "pair_stats_ordered": (f"with {RT}, {st('item_lt_item')}, "
                           "nr as (select movieid, count(*) as num_raters from rt group by movieid) "
                           "select st.*, a.num_raters, b.num_raters as num_raters2 from st "
                           "join nr a on st.movie1 = a.movieid join nr b on st.movie2 = b.movieid"),
    "similarity": f"with {sim('user_lt_item')} select movie1, movie2, corr from sim",
    "similarity_ordered": f"with {sim('item_lt_item')} select movie1, movie2, corr from sim",
    "similarity_stats": (f"with {RT}, {st('user_lt_item')}, c as (select {CORR} as corr from st) "
                         "select count(*) as pairs, "
                         "count(*) filter (where corr is not null and not isnan(corr)) as kept, "
                         "count(*) filter (where corr is null or isnan(corr)) as dropped from c"),
    "liked_items": f"with {RT} select userid, movieid from rt where rating > 4",
    "similar_per_user": f"with {chain()} select * from spu",
    "drop_self_pairs": f"with {chain()} select * from sp",
    "candidates_outer": f"with {chain()} select * from co",
    "candidates_seen": f"with {chain()} select * from cd",
    "candidates_unseen": f"with {chain(candidates='unseen')} select * from cd",
    "max_correlation": f"with {chain()} select * from mx",
    "best_candidates": f"with {chain()} select * from best",
    "best_candidates_double": f"with {chain(narrow=False)} select * from best",
    "best_candidates_unseen": f"with {chain(candidates='unseen')} select * from best",
    "best_candidates_joinback": f"with {chain()} select * from best",
    "predictions": predictions(),
    "predictions_double": predictions(narrow=False),
    "predictions_unseen": predictions(candidates="unseen"),
    "predictions_ordered": predictions(pair_filter="item_lt_item"),
    "predictions_ordered_unseen": predictions(pair_filter="item_lt_item", candidates="unseen"),
}
