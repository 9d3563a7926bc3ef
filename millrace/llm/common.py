"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import work_dir

ROW = "_input_row"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: no recomputation, no lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one; null reads as empty."""
    for value in batch.column(column):
        yield value.as_py() or ""


def row_texts(batch: pa.RecordBatch) -> Iterator[str]:
    """The texts of a batch of whole rows (see :func:`packed`), which need no second column; null reads as empty."""
    for value in batch.column(ROW).field("text"):
        yield value.as_py() or ""


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, whole row): the row travels as one struct, so no input column name can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW),
    )
