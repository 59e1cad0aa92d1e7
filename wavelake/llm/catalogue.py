"""The queries of this package, and the SQL that gives the same rows where SQL can."""

from wavelake.llm import language, leakage, mixing, neighbours, overlap, pieces, quota, related, sql

MODULES = [overlap, related, neighbours, pieces, quota, leakage, mixing, language]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return dict(sql.SQL)
