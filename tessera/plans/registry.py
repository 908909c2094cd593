"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from tessera.plans import cf, email_jobs, io_jobs, oracle_cf, table_jobs, text_jobs

_MODULES = [(cf.QUERIES, oracle_cf.ORACLE), (text_jobs.QUERIES, text_jobs.ORACLE),
            (io_jobs.QUERIES, io_jobs.ORACLE), (table_jobs.QUERIES, table_jobs.ORACLE),
            (email_jobs.QUERIES, email_jobs.ORACLE)]


def queries():
    out = {}
    for q, _ in _MODULES:
        out.update(q)
    return out


def oracle_sql():
    out = {}
    for _, o in _MODULES:
        out.update(o)
    return out
