"""String column expressions with the exact semantics of the original jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rtrim_spaces(c: Column) -> Column:
    # Spark's rtrim removes ASCII spaces only, like the Java split rule below.
    return F.rtrim(c)


def java_split_space(c: Column) -> Column:
    """``String.split(" ")`` of Java as an array expression.

    Leading and inner empty tokens are kept, trailing empty tokens are
    dropped, ``""`` gives ``[""]`` and an all-space string gives ``[]``.
    """
    t = _rtrim_spaces(c)
    return (F.when((c != F.lit("")) & (t == F.lit("")), F.array().cast("array<string>"))
             .otherwise(F.split(t, " ", -1)))


def text_lines(c: Column) -> Column:
    """Split a text blob into the lines a text-file scan would return.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; a terminator at the very end
    does not start another (empty) line, and an empty text has no lines.
    Texts without CR take the single-character split (no regex engine).
    """
    lf_body = F.when(c.endswith("\n"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)
    any_body = F.regexp_replace(c, "(\r\n|\n|\r)\\z", "")
    return (F.when(c == F.lit(""), F.array().cast("array<string>"))
             .when(F.instr(c, "\r") == 0, F.split(lf_body, "\n", -1))
             .otherwise(F.split(any_body, "\r\n|\n|\r", -1)))


def column_correction(c: Column) -> Column:
    """Replace ``_`` by a space in column 1 (0-based) of a comma line.

    Java ``split(",")`` semantics (trailing empty columns dropped); the line
    is rebuilt with ``,`` but leading empty columns are dropped, exactly
    like a builder that only emits a separator once it is non-empty.  A
    line with fewer than two columns raises, as the original does.
    """
    cols = F.split(F.regexp_replace(c, ",+$", ""), ",", -1)
    fixed = F.transform(cols, lambda x, i: F.when(i == 1, F.replace(x, F.lit("_"), F.lit(" ")))
                        .otherwise(x))
    rebuilt = F.regexp_replace(F.array_join(fixed, ","), "^,+", "")
    return F.when(F.size(cols) < 2,
                  F.raise_error(F.concat(F.lit("column correction needs at least 2 columns: "),
                                         F.coalesce(c, F.lit("NULL"))))
                  ).otherwise(rebuilt)


def scala_list_string(c: Column) -> Column:
    """Render an array of strings as Scala's ``List(a, b)``."""
    return F.concat(F.lit("List("), F.array_join(c, ", "), F.lit(")"))


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def empty_array_if_null(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))
