"""Writers: text, delimited, Parquet with a codec, key-value pairs, tables.

Write modes map onto the original's behaviours: delete-then-write is
``overwrite``; refusing an existing output is ``errorifexists`` (an
exception, never a process exit).  Every writer writes one part file per
partition from the executors; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARQUET_BLOCK_SIZE = 25 * 1024 * 1024  # fixed value: 25 MiB row groups

# Accepted codec names (case-sensitive); anything else is uncompressed.
CODECS = {"GZIP": "gzip", "SNAPPY": "snappy"}

WRITE_MODES = ("overwrite", "errorifexists", "append", "ignore")


def parquet_codec(name: str | None) -> str:
    """``GZIP``/``SNAPPY`` → that codec, anything else → ``uncompressed``."""
    return CODECS.get(name or "", "uncompressed")


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row from a single string column."""
    if len(df.columns) != 1:
        raise ValueError("write_text needs exactly one string column")
    df.write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """``concat_ws`` of all columns as text (Java number formatting)."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")
    df.select(line).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def write_parquet(df: DataFrame, path: str, codec: str | None = None, mode: str = "overwrite",
                  block_size: int = PARQUET_BLOCK_SIZE) -> None:
    (df.write.mode(mode)
       .option("compression", parquet_codec(codec))
       .option("parquet.block.size", str(block_size))
       .parquet(path))


def write_pairs(df: DataFrame, path: str, key: str, value: str, mode: str = "overwrite") -> None:
    """(key, value) storage: a Parquet table, JVM-side, in place of sequence
    files, which no DataFrame writer knows."""
    df.select(key, value).write.mode(mode).parquet(path)


def read_pairs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    df.write.mode(mode).format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)
