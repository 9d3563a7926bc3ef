"""Sequence packing by non-negative least squares over the histogram of piece lengths.

Documents are cut into full windows and one remainder.  Shallow combinations of lengths that fill a
window exactly ({w}, {a, b}, {a, a, b}, {a, a, a, b}) are enumerated, their repeat counts are solved
against the histogram by non-negative least squares, rounded to what the histogram holds, and what is
left is packed greedily, longest first, cut where a window ends.  Only the last sequence is padded.

The histogram (at most ``window`` rows) and the plan (a few rows per length) are the only data on the
driver or broadcast.  The place of a piece follows from its rank among the pieces of its length by
arithmetic; ranks come from counts per task and length, so a length that many pieces share is never
gathered in one task.

Defined results: a null or empty text is the end token alone; rows are packed one by one, so repeated
rows and null ids need nothing special; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, texts
from millrace.llm.tokens import encoder

WINDOW = 2048
END_ID = 1
DEPTH = 4
SWEEPS = 200
ID_BYTES = 4


def combinations(histogram: dict[int, int], window: int = WINDOW, depth: int = DEPTH) -> list[dict[int, int]]:
    """Length -> copies, for each way to fill a window with up to ``depth`` pieces of at most two lengths."""
    found = {((window, 1),)} if window in histogram else set()
    for a in histogram:
        for copies in range(1, depth):
            b = window - copies * a
            if b == a and a < window:
                found.add(((a, copies + 1),))
            elif b in histogram and b != a:
                found.add(tuple(sorted(((a, copies), (b, 1)))))
    return [dict(c) for c in sorted(found)]


def solve(histogram: dict[int, int], columns: list[dict[int, int]], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |sum of x * column - histogram|^2, by coordinate descent."""
    x = np.zeros(len(columns))
    left = {length: float(count) for length, count in histogram.items()}
    for _ in range(sweeps):
        moved = 0.0
        for k, column in enumerate(columns):
            gradient = sum(n * left[length] for length, n in column.items())
            new = max(0.0, x[k] + gradient / sum(n * n for n in column.values()))
            step = new - x[k]
            if step:
                x[k] = new
                for length, n in column.items():
                    left[length] -= n * step
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, copies, first sequence, offset, position): where pieces go.

    Ranks [first, end) of a length stand in one combination, ``copies`` to a sequence from ``offset`` on;
    rows with copies 0 stand one after the other in the stream of residuals from ``position`` on.
    """
    rows, used, sequence = [], dict.fromkeys(histogram, 0), 0
    columns = combinations(histogram, window)
    repeats = solve(histogram, columns)
    for k in sorted(range(len(columns)), key=lambda k: (-repeats[k], k)):
        times = min(round(float(repeats[k])), *((histogram[a] - used[a]) // n for a, n in columns[k].items()))
        if times > 0:
            offset = 0
            for length, copies in sorted(columns[k].items(), reverse=True):
                end = used[length] + times * copies
                rows.append((length, used[length], end, copies, sequence, offset, 0))
                used[length], offset = end, offset + length * copies
            sequence += times
    rest = [(length, histogram[length] - used[length]) for length in sorted(histogram, reverse=True)]
    for (length, count), position in zip(rest, accumulate((a * n for a, n in rest), initial=0), strict=False):
        if count:
            rows.append((length, used[length], histogram[length], 0, sequence, 0, position))
    return rows


PLAN = "length int, first long, end long, copies long, sequence long, off long, position long"
PIECES = "doc_id long, start long, length int, doc_tokens long, part int, place long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document with their ids; ``place`` counts the pieces of a length within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        part, places = TaskContext.get().partitionId(), [0] * (window + 1)
        names = ["doc_id", "start", "length", "doc_tokens", "part", "place", "ids"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                ids = words.encode(text) + last
                total = len(ids) // ID_BYTES
                for start in range(0, total, window):
                    length = min(window, total - start)
                    piece = ids[start * ID_BYTES : (start + length) * ID_BYTES]
                    rows.append((doc_id, start, length, total, part, places[length], piece))
                    places[length] += 1
                    held += len(piece)
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = stored(token_pieces(docs, tokenizer_path, window, end_id), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("pieces")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    places = docs.sparkSession.createDataFrame(plan(histogram, window), PLAN)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place")).alias("p")
    at = ranked.join(
        F.broadcast(places.alias("q")), F.expr("p.length = q.length and rank >= first and rank < end")
    ).select("doc_id", "start", "doc_tokens", "ids", "p.length", "copies", "sequence", "off", F.expr("rank - first").alias("nth"), "position")
    stream = F.expr("position + nth * length")
    # A residual is cut where its window ends; no other piece is.
    room = F.least(F.col("length").cast("long"), window - F.pmod(stream, F.lit(window)))
    whole = F.struct(
        F.lit(0).cast("long").alias("skip"),
        F.col("length").cast("long").alias("length"),
        F.expr("sequence + nth div copies").alias("sequence_id"),
        F.expr("off + (nth % copies) * length").alias("offset"),
    )
    head = F.struct(
        F.lit(0).cast("long").alias("skip"),
        room.alias("length"),
        (F.col("sequence") + F.floor(stream / window)).alias("sequence_id"),
        F.pmod(stream, F.lit(window)).alias("offset"),
    )
    tail = F.struct(
        room.alias("skip"),
        (F.col("length") - room).alias("length"),
        (F.col("sequence") + F.floor(stream / window) + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    cut = F.when(F.col("copies") > 0, F.array(whole)).otherwise(F.filter(F.array(head, tail), lambda c: c["length"] > 0))
    ids = F.expr(f"substring(ids, cast(c.skip * {ID_BYTES} + 1 as int), cast(c.length * {ID_BYTES} as int))")
    return (
        at.withColumn("c", F.explode(cut))
        .select("doc_id", (F.col("start") + F.col("c.skip")).alias("start"), "c.length", ids.alias("ids"), "doc_tokens", "c.sequence_id", "c.offset")
        .withColumn("ids_crc32", F.crc32("ids"))
    )


DIGEST = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packed_rows(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(docs, tokenizer_path).select(*DIGEST)


def op6_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
