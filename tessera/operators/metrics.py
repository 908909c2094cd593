"""Processed / failed item counters computed while a job runs.

``observe`` attaches named aggregate metrics to a DataFrame with
:class:`pyspark.sql.Observation`; the values are filled in when the first
action on the returned DataFrame finishes (for example the write that
materialises it), so counting costs no extra pass.  Metrics of failed and
retried tasks are not double counted.

:func:`timed_counts` counts items together with the time spent on them: the
worker carries each item's elapsed time as a column of its row, and the sums are
observed like any other metric.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe(df: DataFrame, name: str | None = None, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Return ``(observed_df, observation)``; read ``observation.get`` after an action."""
    obs = Observation(name or f"metrics_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, *[c.alias(k) for k, c in metrics.items()]), obs


def timed_counts(name: str, wanted: Column, micros: str) -> dict[str, Column]:
    """Metrics ``name`` (items where ``wanted``) and ``<name>_elapsed_ms`` (their time)."""
    spent = F.coalesce(F.sum(F.when(wanted, F.col(micros))), F.lit(0)) / 1000
    return {name: F.count_if(wanted), f"{name}_elapsed_ms": spent.cast("double")}
