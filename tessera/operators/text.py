"""Line, word and delimited-line jobs.

All of them are projections and global aggregates, so they are planned as
one scan → project → (partial) aggregate pipeline inside whole-stage
codegen; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.strings import column_correction, java_split_space, text_lines


def lines_of(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, line_no, value)``: each document split into its lines (1-based)."""
    return docs.select(F.col(id_col), F.posexplode(text_lines(F.col(text_col))).alias("pos", "value")) \
               .select(id_col, (F.col("pos") + 1).alias("line_no"), "value")


def tokenize(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per token of each line (Java ``split(" ")`` semantics)."""
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, F.posexplode(java_split_space(F.col(value_col))).alias("pos", "word")) \
                .select(*keep, (F.col("pos") + 1).alias("word_no"), "word")


def word_count_total(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``(lines, words)``: global line and token counts.

    Tokens are counted with ``size`` of the split — no row per token is
    ever produced — and summed with partial aggregation.
    """
    return lines.agg(F.count(F.lit(1)).alias("lines"),
                     F.sum(F.size(java_split_space(F.col(value_col))).cast("long")).alias("words"))


def correct_columns(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Column correction of each line (see :func:`column_correction`)."""
    return lines.select(column_correction(F.col(value_col)).alias(value_col))


def map_scale(df: DataFrame, col: str, factor: int = 10, times: int = 1) -> DataFrame:
    """Multiply ``col`` by ``factor``, ``times`` times (a row map)."""
    c = F.col(col)
    for _ in range(times):
        c = c * F.lit(factor)
    return df.withColumn(col, c)


def global_sum(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """Cluster-side sum (no values are brought to the driver)."""
    return df.agg(F.sum(col).alias(alias))
