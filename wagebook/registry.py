"""Registered queries over the payslip operators, with SQL that gives their results from the tables directly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagebook.plans import queries_documents, queries_store, queries_text

PARTS = [queries_text, queries_documents, queries_store]


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payslips read back from positioned words, counted by year."""
    return queries()["r1_year_coverage"](spark, sf_dir)


def queries() -> dict:
    return {k: q for p in PARTS for k, (q, _) in p.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for p in PARTS for k, (_, s) in p.QUERIES.items() if s}
