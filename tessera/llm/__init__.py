"""Operators for preparing training data: dedup, filtering, scoring, packing.

Nothing outside this subpackage imports it.  ``registry.queries()`` and
``registry.oracle_sql()`` list one query per operator plus the pipeline.

Rules shared by every operator here:

* an operator reads only the columns it names; further columns, whatever
  their names, are ignored and never collide with its own;
* a null text is an empty text; a null id keeps its row in per-row results
  and is left out of results that name rows by id;
* an empty table gives an empty result with the same columns.
"""
