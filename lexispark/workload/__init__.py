"""Registered queries over the given tables, with the SQL they are checked against."""

from lexispark.workload import evaluation, features, models, profiles, splits, svm, tables, texts

PARTS = (tables, profiles, texts, features, splits, models, evaluation, svm)


def all_queries() -> dict:
    return {name: fn for part in PARTS for name, fn in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.SQL.items()}
