"""JDBC tables as text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import snake_to_camel


def read_table(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    camel_case: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or query, every value as text, names optionally in camel case.

    Credentials and parallel-read settings (``partitionColumn, lowerBound, upperBound,
    numPartitions``) come in through ``options``.
    """
    target = {"dbtable": table} if table else {"query": query}
    rows = spark.read.format("jdbc").options(url=url, **target, **(options or {})).load()
    return as_text_columns(rows, camel_case)


def as_text_columns(rows: DataFrame, camel_case: bool = False) -> DataFrame:
    name = snake_to_camel if camel_case else str
    return rows.select(*[F.col(c).cast("string").alias(name(c)) for c in rows.columns])


def rows_with(rows: DataFrame, **equals: str) -> DataFrame:
    """The rows whose columns equal the given values; the filter reaches the database."""
    for column, value in equals.items():
        rows = rows.where(F.col(column) == value)
    return rows
