"""A table that micro-batches append to and read back: what earlier batches established.

Layout: ``root/gen=G/batch_id=N``.  A generation spans ``every`` batches.  Its first
batch rewrites the previous generation, compacted, as its own base, so reads touch one
base and fewer than ``every`` small increments.  Batch N reads only what batches before
N wrote, and committed increments are never rewritten: replaying a batch after a lost
executor or a restart gives the same result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.topics import is_complete, path_exists


class StaleLedger(RuntimeError):
    """The newest increment is older than its reader allows."""


def keep_all(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str
    schema: str
    compact: Callable[[DataFrame], DataFrame] = keep_all
    every: int = 100
    # columns that part every increment into folders, so that a filter on them reads only its own
    partition_by: tuple[str, ...] = ()

    def append(self, batch_id: int, rows: DataFrame) -> DataFrame:
        """Write the increment of a batch once and return it as read back."""
        path = f"{self._generation(batch_id)}/batch_id={batch_id}"
        given = {f.name: f.dataType.simpleString() for f in rows.schema}
        for column in T.StructType.fromDDL(self.schema):
            wanted = column.dataType.simpleString()
            # such rows could be written, but never read again
            if given.get(column.name) != wanted:
                raise ValueError(f"{column.name} is {given.get(column.name)}, the ledger holds {wanted}")
        if not is_complete(self.spark, path):
            rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def before(self, batch_id: int) -> DataFrame:
        """Everything written by batches before ``batch_id``, with its ``batch_id``."""
        self._ensure_base(batch_id)
        return self._read(self._generation(batch_id), batch_id)

    def upto(self, batch_id: int) -> DataFrame:
        """Everything written by batches up to and including ``batch_id``."""
        self._ensure_base(batch_id)
        return self._read(self._generation(batch_id), batch_id + 1)

    def newest(self, max_age: float | None = None, clock: Callable[[], float] = time.time) -> int | None:
        """The last batch whose increment is committed, None before the first.

        With ``max_age`` an increment that was committed more than so many seconds ago is an error: the job that writes
        the ledger, one increment per batch, has fallen behind.
        """
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/gen=*/batch_id=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        last = max(((int(f.getPath().getParent().getName()[9:]), f.getModificationTime()) for f in found), default=None)
        if last is None:
            return None
        if max_age is not None and clock() - last[1] / 1000 > max_age:
            raise StaleLedger(f"batch {last[0]} of {self.root} is more than {max_age} seconds old")
        return last[0]

    def expire(self, batch_id: int) -> list[str]:
        """Delete the generations that batch ``batch_id`` and later ones no longer read; their folders are returned."""
        self._ensure_base(batch_id)
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/gen=*")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = [f.getPath() for f in files.globStatus(pattern) or [] if int(f.getPath().getName()[4:]) < batch_id // self.every]
        return [str(p.getName()) for p in old if files.delete(p, True)]

    def _ensure_base(self, batch_id: int) -> None:
        generation = batch_id // self.every
        if generation == 0:
            return
        first = generation * self.every
        base = f"{self._generation(batch_id)}/batch_id={first - 1}"
        if not is_complete(self.spark, base):
            self._ensure_base(first - 1)
            old = self._read(self._generation(first - 1), first)
            folded = self.compact(old).drop("batch_id")
            folded.write.mode("overwrite").partitionBy(*self.partition_by).parquet(base)

    def _generation(self, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/gen={batch_id // self.every}"

    def _read(self, path: str, batch_id: int) -> DataFrame:
        schema = f"{self.schema}, batch_id long"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).where(F.col("batch_id") < batch_id)
