"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import (ann, decontaminate, html, lm, neardup, packing, periodic, phrases, sharding,
                         substrings, tokencount, toxicity, urls)
from tessera.llm.common import table

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op1_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


def op4_language_model(spark, sf_dir):
    fold = toxicity.remainder("doc_id", 10)
    return lm.scores(table(spark, sf_dir, "documents"), F.coalesce(fold != 0, F.lit(True)),
                     F.coalesce(fold == 0, F.lit(False)))


def op5_substring_dedup(spark, sf_dir):
    return substrings.dedup_digest(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


def op7_html_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5)


def op11_periodic_runs(spark, sf_dir):
    return periodic.run_digest(table(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    return tokencount.token_counts(table(spark, sf_dir, "documents"), limit=4096)


def op13_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), lengths=3, min_count=10, first=2000, covered=50)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _shingles_sql(name: str, key: str, source: str, n: int) -> str:
    """CTE ``name(key, g)``: the distinct n-word shingles of each text."""
    return f"""{name}_w as (select {key}, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\\x20\\x09-\\x0D]+'),
            lambda x: x <> '') as w from {source}),
        {name} as (select distinct {key}, unnest(case when len(w) = 0 then []
            when len(w) < {n} then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - {n} + 2),
                                lambda i: array_to_string(w[i:i + {n - 1}], ' ')) end) as g from {name}_w)"""


_RULE_SQL = ", ".join(f"('{v}', '{e.partition('/')[0]}', '/{e.partition('/')[2]}', '{e}')"
                      for v, e in URL_RULES)

ORACLE = {
    "op1_decontamination": f"""
        with {_shingles_sql("d", "doc_id", "documents", 5)},
        {_shingles_sql("b", "item_id", "benchmark", 5)},
        sizes as (select item_id, count(*) as n_item from b group by item_id)
        select d.doc_id, b.item_id, n_item, count(*) as n_shared, count(*) / n_item as containment
        from d join b on d.g = b.g join sizes on sizes.item_id = b.item_id
        group by d.doc_id, b.item_id, n_item having count(*) * 100 >= n_item * 80""",
    "op6_near_duplicates": f"""
        with recursive {_shingles_sql("s", "doc_id", "documents", 2)},
        sizes as (select doc_id, count(*) as n from s group by doc_id),
        common as (select a.doc_id as x, b.doc_id as y, count(*) as k
            from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by x, y),
        links as (select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
            where 100 * k >= 80 * (p.n + q.n - k)),
        reach as (select doc_id as x, doc_id as y from documents
            union select r.x, l.y from reach r join links l on l.x = r.y)
        select d.doc_id, coalesce(z.n, 0) as n_shingles, min(r.y) as component_id,
               d.doc_id = min(r.y) as kept
        from documents d left join sizes z on z.doc_id = d.doc_id join reach r on r.x = d.doc_id
        group by d.doc_id, z.n""",
    "op13_collocations": f"""
        with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) as p
            from documents),
        words as (select lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') as w
            from pieces),
        grams as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
            from words, (values (1), (2), (3)) as sizes(m) where len(w) >= m),
        counts as (select lang, m, phrase, count(*) as a from grams group by lang, m, phrase),
        total as (select lang, sum(a)::bigint as n from counts where m = 1 group by lang),
        cand as (select *, string_split(phrase, ' ') as w from counts where m >= 2 and a >= 10),
        cuts as (select lang, m, phrase, a, k, array_to_string(w[1:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y
            from cand, (values (1), (2)) as ks(k) where k < m),
        scored as (select c.*, p.a as l, q.a as r,
                ((1000000::hugeint * c.a * c.a) // (p.a::hugeint * q.a))::bigint as score
            from cuts c join counts p on p.lang = c.lang and p.phrase = c.x and p.m = c.k
            join counts q on q.lang = c.lang and q.phrase = c.y and q.m = c.m - c.k),
        best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        longer as (select lang, phrase, max(a) as b from (
                select lang, array_to_string(w[1:2], ' ') as phrase, a from cand where m = 3
                union all select lang, array_to_string(w[2:3], ' '), a from cand where m = 3) as sub
            group by lang, phrase),
        kept as (select b.* from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase
            where o.b is null or 100 * o.b < 50 * b.a),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
        select d.lang, d.rank, d.phrase, d.a, d.l, d.r, t.n, d.score
        from ranked d join total t on t.lang = d.lang where d.rank <= 2000""",
    "op2_url_filter": f"""
        with rules(verdict, host, path, rule) as (values {_RULE_SQL}),
        cut as (select page_id, case when strpos(url, '://') > 0
                  then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
        hosted as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut),
        parts as (select page_id,
            translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from hosted),
        fits as (select p.page_id, r.rule, r.verdict, row_number() over (
              partition by p.page_id order by length(r.host) desc, length(r.path) desc) as k
            from parts p join rules r
              on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
        select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
        from parts p left join fits f on f.page_id = p.page_id and f.k = 1""",
}


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_decontamination, op2_url_filter, op3_sharding, op4_language_model, op5_substring_dedup,
           op6_near_duplicates, op7_html_text, op8_toxicity, op9_packing, op10_nearest_neighbours,
           op11_periodic_runs, op12_token_counts, op13_collocations, pipeline)


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql():
    return dict(ORACLE)
