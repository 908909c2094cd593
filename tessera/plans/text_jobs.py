"""Registered text queries over ``documents``, ``part`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.session import scratch_path
from tessera.sinks.writers import write_text
from tessera.sources.tables import comma_lines, documents, table


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return T.lines_of(documents(spark, sf).select("doc_id", "text"))


def q_scan_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select("doc_id", F.col("line_no").cast("bigint"), "value")


def q_tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return T.tokenize(_lines(spark, sf)).select(
        "doc_id", F.col("line_no").cast("bigint"), F.col("word_no").cast("bigint"), "word")


def q_word_count_total(spark: SparkSession, sf: str) -> DataFrame:
    return T.word_count_total(_lines(spark, sf))


def q_word_count_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The tokens that the word count job saves as text, one a line."""
    path = scratch_path(spark, "tokens")
    write_text(T.tokenize(_lines(spark, sf)).select("word"), path)
    return spark.read.text(path).withColumnRenamed("value", "word")


def q_column_correction(spark: SparkSession, sf: str) -> DataFrame:
    return T.correct_columns(comma_lines(spark, sf).select("value"))


def _linenumbers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")


def q_map_scale(spark: SparkSession, sf: str) -> DataFrame:
    """``x * 10`` then ``* 10`` again, on every line number."""
    df = _linenumbers(spark, sf).withColumn("scaled", F.col("l_linenumber"))
    df = T.map_scale(df, "scaled", 10)
    return df.withColumn("rescaled", F.col("scaled") * 10)


def q_global_sum(spark: SparkSession, sf: str) -> DataFrame:
    df = T.map_scale(_linenumbers(spark, sf), "l_linenumber", 10)
    return T.global_sum(df, "l_linenumber", "total")


QUERIES = {
    "scan_text_lines": q_scan_text_lines,
    "tokenize": q_tokenize,
    "word_count_total": q_word_count_total,
    "word_count_tokens": q_word_count_tokens,
    "column_correction": q_column_correction,
    "map_scale": q_map_scale,
    "global_sum": q_global_sum,
}

_SPLIT_LINES = ("case when text = '' then []::varchar[] else regexp_split_to_array("
                "regexp_replace(text, '(\r\n|\n|\r)\\z', ''), '\r\n|\n|\r') end")
_LINES = (f"ln as (select doc_id, cast(generate_subscripts({_SPLIT_LINES}, 1) as bigint) "
          f"as line_no, unnest({_SPLIT_LINES}) as value from documents)")
_JSPLIT = ("case when value <> '' and rtrim(value, ' ') = '' then []::varchar[] "
           "else string_split(rtrim(value, ' '), ' ') end")

ORACLE = {
    "scan_text_lines": f"with {_LINES} select * from ln",
    "tokenize": (f"with {_LINES}, tk as (select doc_id, line_no, {_JSPLIT} as w from ln) "
                 "select doc_id, line_no, cast(generate_subscripts(w, 1) as bigint) as word_no, "
                 "unnest(w) as word from tk"),
    "word_count_tokens": f"with {_LINES} select unnest({_JSPLIT}) as word from ln",
    "word_count_total": (f"with {_LINES} select count(*) as lines, "
                         f"cast(sum(len({_JSPLIT})) as bigint) as words from ln"),
    "column_correction": (
        "with c as (select string_split(regexp_replace(concat_ws(',', cast(p_partkey as varchar), "
        "replace(p_name, ' ', '_'), p_brand), ',+$', ''), ',') as cols from part) "
        "select regexp_replace(array_to_string(list_transform(cols, lambda x, i: "
        "case when i = 2 then replace(x, '_', ' ') else x end), ','), '^,+', '') as value from c"),
    "map_scale": ("select l_orderkey, l_linenumber, l_linenumber * 10 as scaled, "
                  "l_linenumber * 10 * 10 as rescaled from lineitem"),
    "global_sum": "select cast(sum(l_linenumber * 10) as bigint) as total from lineitem",
}
