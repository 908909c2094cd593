"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(n: Column, dot: Column, s1: Column, s2: Column, q1: Column, q2: Column) -> Column:
    """Pearson correlation from pair sums.

    ``(n·Σxy − Σx·Σy) / (√(n·Σx² − (Σx)²) · √(n·Σy² − (Σy)²))``.
    Division follows IEEE 754 in ANSI mode, too: over a zero denominator (zero
    variance) a non-zero numerator, as rounding can leave it, gives ±Infinity
    and a zero one NaN.  Callers drop NaN and keep infinities.
    Spark's ``corr`` aggregate is not used: it raises on zero variance.
    """
    n = n.cast("double")
    num = n * dot - s1 * s2
    den = F.sqrt(n * q1 - s1 * s1) * F.sqrt(n * q2 - s2 * s2)
    inf = F.lit(float("inf"))
    by_zero = F.when(num > 0, inf).when(num < 0, -inf).otherwise(F.lit(float("nan")))
    return F.when(den == 0, F.when(F.isnan(num), num).otherwise(by_zero)).otherwise(F.try_divide(num, den))


def is_defined_number(c: Column) -> Column:
    """True when ``c`` is neither NULL nor NaN; infinities are numbers."""
    return c.isNotNull() & ~F.isnan(c)


def narrow_to_float(c: Column) -> Column:
    """Store a double in a FLOAT column and read it back as DOUBLE.

    Reproduces a FLOAT-typed table column feeding a DOUBLE result: the
    value loses precision (0.8660254037844387 → 0.8660253882408142).
    """
    return c.cast("float").cast("double")
