"""Delimited text readers.

* :func:`read_ratings_strict` — tab-separated ``user, item, rating[, ...]``
  where a short line or an unparsable number fails the job.
* :func:`read_delimited` — declared-schema reader where a bad field turns
  into NULL, like a schema-on-read text table.
* :func:`register_external_table` — a table over a directory that another
  job writes (``CREATE TABLE ... USING csv LOCATION``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The written forms of numbers and timestamps in text tables.
_INTEGER = r"^[+-]?[0-9]+$"
_DOUBLE = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$"

RATING_SCHEMA = T.StructType([
    T.StructField("userID", T.IntegerType()),
    T.StructField("movieID", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("time", T.IntegerType()),
])

USER_SCHEMA = T.StructType([
    T.StructField("userID", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("zip_code", T.StringType()),
])

# The genre flag columns of the movie table, in file order.
GENRE_COLUMNS = [
    "type_unknown", "type_Action", "type_Adventure", "type_Animation", "type_Children",
    "type_Crime", "type_Documentary", "type_Drama", "type_Fantasy", "type_FilmNoir",
    "type_Horror", "type_Musical", "type_Mystery", "type_Romance", "type_SciFi",
    "type_War", "type_Western",
]

MOVIE_SCHEMA = T.StructType(
    [T.StructField("movieID", T.IntegerType()),
     T.StructField("movieName", T.StringType()),
     T.StructField("release_date", T.TimestampType()),
     T.StructField("video_release_date", T.TimestampType()),
     T.StructField("imdb_link", T.StringType())]
    + [T.StructField(g, T.BooleanType()) for g in GENRE_COLUMNS])

SIMILARITY_SCHEMA = T.StructType([
    T.StructField("movieID1", T.IntegerType()),
    T.StructField("movieID2", T.IntegerType()),
    T.StructField("correlation_factor", T.FloatType()),
])


def read_ratings_strict(spark: SparkSession, path: str) -> DataFrame:
    """``(userid bigint, movieid bigint, rating double)``; extra fields ignored.

    A line with fewer than three fields, a non-numeric value or a padded
    integer fails the job, whichever columns are read (also for a ``count``)
    and with ANSI mode off: the check is a filter on the line itself.
    """
    f = F.split(F.col("value"), "\t", -1)
    user, item, rating = F.get(f, F.lit(0)), F.get(f, F.lit(1)), F.get(f, F.lit(2))
    number = F.regexp_replace(F.trim(rating), "(?<=[0-9.])[dDfF]$", "")
    long_ = lambda c: F.when(c.rlike(_INTEGER), c.try_cast("bigint"))
    double = F.when(number.rlike(_DOUBLE), number.try_cast("double"))
    good = long_(user).isNotNull() & long_(item).isNotNull() & double.isNotNull()
    failed = F.raise_error(F.concat(F.lit("malformed rating line: "), F.col("value"))).cast("boolean")
    return (spark.read.text(path).where(F.when(good, F.lit(True)).otherwise(failed))
            .select(long_(user).alias("userid"), long_(item).alias("movieid"), double.alias("rating")))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    """Schema-on-read delimited text, by the rules of a text table.

    ``\\N``, a missing field and a field that does not parse are NULL; an empty
    string stays an empty string; a blank line is a row; booleans are ``true``
    and ``false`` only; numbers are not trimmed.
    """
    f = F.split(F.col("value"), f"\\Q{sep}\\E", -1)

    def field(i: int, kind: T.DataType):
        raw = F.get(f, F.lit(i))
        raw = F.when(raw != "\\N", raw)
        if isinstance(kind, T.StringType):
            return raw
        if isinstance(kind, T.BooleanType):
            return F.when(F.lower(raw).isin("true", "false"), F.lower(raw) == "true")
        form = (_INTEGER if isinstance(kind, T.IntegralType) else
                _TIMESTAMP if isinstance(kind, T.TimestampType) else _DOUBLE)
        return F.when(raw.rlike(form), raw.try_cast(kind))

    return spark.read.text(path).select(
        *[field(i, c.dataType).alias(c.name) for i, c in enumerate(schema.fields)])


def register_external_table(spark: SparkSession, name: str, path: str,
                            schema: T.StructType, sep: str) -> DataFrame:
    """Create (or replace) a table over files at ``path`` and return it."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING csv "
              f"OPTIONS (sep '{sep}', mode 'PERMISSIVE', quote '\\u0000', escape '\\u0000') "
              f"LOCATION '{path}'")
    return spark.table(name)


@contextmanager
def external_table(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> Iterator[DataFrame]:
    """A table over files at ``path`` under a name of its own, dropped on leaving.

    The files stay, and the DataFrame keeps reading them after the drop.
    """
    name = f"external_{uuid.uuid4().hex}"
    try:
        yield register_external_table(spark, name, path, schema, sep)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def move_overwrite(spark: SparkSession, source_path: str, target_path: str) -> None:
    """Make the files at ``source_path`` the contents of ``target_path``, by moving.

    No byte is read or written (on a store with real renames).  The old contents
    are set aside first, put back if the move fails, and deleted once it is
    done; a failed load thus leaves target and source as they were.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    src, dst = path(source_path), path(target_path)
    store = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(src):
        raise FileNotFoundError(f"nothing to load at {source_path}")
    aside = path(f"{target_path.rstrip('/')}-before-{uuid.uuid4().hex[:12]}")
    had = store.exists(dst)
    if had and not store.rename(dst, aside):
        raise OSError(f"cannot set aside {target_path}")
    try:
        if store.getFileStatus(src).isFile():
            store.mkdirs(dst)
        else:
            store.mkdirs(dst.getParent())
        if not store.rename(src, dst):
            raise OSError(f"cannot move {source_path} to {target_path}")
    except BaseException:
        if had:
            store.delete(dst, True)
            store.rename(aside, dst)
        raise
    if had:
        store.delete(aside, True)


def load_overwrite(spark: SparkSession, source_path: str, schema: T.StructType, sep: str,
                   target_path: str) -> DataFrame:
    """Replace the contents of a table location by the source files, which are moved.

    The table is the files as they came, read with the declared schema.
    """
    move_overwrite(spark, source_path, target_path)
    return read_delimited(spark, target_path, schema, sep)
