"""The catalogue of queries: name -> callable(spark, folder), and name -> SQL that gives the same rows."""

from wavelake.queries import data_quality, numbers, signals, timeline

MODULES = [data_quality, timeline, numbers, signals]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
