"""SimHash near-dedup by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ in at most 3 bits share
at least 5 of them.  The index posts each distinct fingerprint under its positional bytes, taken three
at a time in two fixed halves of four positions: of any 5 shared positions at least 3 lie in one half, so
every such pair meets in a posting.  In a posting the shared positional bytes of two fingerprints
are tallied, pairs below the guaranteed 5 are dropped, and the others are verified by their differing bits.
A posting gives one link per fingerprint, to the first of its group, instead of all pairs.

Postings of more than SPLIT fingerprints are posted again under all fives that contain their three
positions, which loses no pair.  Fingerprints are distinct, so such a posting, whose members share 40 bits, can hold
no more than the 2 ** 24 values of the other three bytes (128 MB), whatever the size of the corpus.

Defined results: a null text has no words; no words give fingerprint zero, linked like any other; equal texts
and repeated rows have equal fingerprints and one component; component_id is the smallest doc_id reachable,
null ids aside (null only where all are); an empty table gives no rows; other columns of any name pass
through :func:`near_distinct`, which keeps one of repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ROW, packed, stored, texts
from millrace.llm.components import components

SHINGLE = 3
NEAR = 3
SHARED = 8 - NEAR
THREES = [c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(half, 3)]
FIVES = list(combinations(range(8), SHARED))
SPLIT = 4096
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str, words: int, block: int = 1 << 16) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, at most ``block`` at a time; a text of fewer words is one shingle."""
    parts = text.encode().translate(LOWER).split()
    if not parts:
        return
    count = max(1, len(parts) - words + 1)
    for start in range(0, count, block):
        stop = min(count, start + block)
        some = parts[start : stop + words - 1]
        line = b" ".join(some)
        ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1) - 1
        begins = [0, *(ends[:-1] + 1).tolist()]
        ends = ends[min(words, len(some)) - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        yield np.array([digest(line[a:b], 42) for a, b in zip(begins, ends, strict=False)], np.uint64)


def fingerprint(text: str, words: int = SHINGLE, block: int = 1 << 16) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    sums, count = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words, block):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    return sum(1 << k for k in np.flatnonzero(2 * sums > count).tolist())


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, text_key) of each row; fp is the fingerprint as a signed 64-bit integer, text_key a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _signed([fingerprint(text) for text in texts(batch)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), values, batch.column("text_key")], names=["doc_id", "fp", "text_key"]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    ).mapInArrow(run, "doc_id long, fp long, text_key long")


def _keys(fp, sets) -> F.Column:
    """One key (set number, the bytes at its positions) per set of positions."""
    keys = []
    for number, places in enumerate(sets):
        mask = sum(0xFF << (8 * p) for p in places)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(number).alias("set"), fp.bitwiseAND(F.lit(mask)).alias("bytes")))
    return F.array(*keys)


def link_posting(values: np.ndarray) -> np.ndarray:
    """For each distinct fingerprint of a posting, the first one of its group of verified pairs."""
    order = np.argsort(values, kind="stable")
    bits = values.view(np.uint64)[order]
    first = np.empty(len(bits), np.uint64)
    left = np.arange(len(bits))
    while len(left):
        queue, root = [left[0]], bits[left[0]]
        first[left[0]] = root
        left = left[1:]
        while queue and len(left):
            differing = bits[left] ^ bits[queue.pop()]
            shared = (differing[:, None].view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = shared >= SHARED
            near[near] = np.bitwise_count(differing[near]) <= NEAR
            found = left[near]
            first[found] = root
            queue.extend(found.tolist())
            left = left[~near]
    out = np.empty(len(bits), np.int64)
    out[order] = first.view(np.int64)
    return out


def _links(postings: DataFrame) -> DataFrame:
    """(a, b) links of each posting's groups; postings hold (fps)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, heads = [], []
            for value in batch.column("fps"):
                values = value.values.to_numpy(zero_copy_only=False)
                first = link_posting(values)
                moved = first != values
                ends.append(values[moved])
                heads.append(first[moved])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64()) for x in (ends, heads)],
                names=["a", "b"],
            )

    return postings.select("fps").mapInArrow(run, "a long, b long")


def near_links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) whose closure is that of all near pairs."""
    posted = distinct.select(F.explode(_keys(F.col("fp"), THREES)).alias("key"), "fp")
    sizes = posted.groupBy("key").agg(F.count("*").alias("size"))
    large = stored(sizes.where(F.col("size") > split).select("key"), "large_postings")
    few = posted.join(sizes.where(F.col("size").between(2, split)).select("key"), "key", "left_semi")
    links = _links(few.groupBy("key").agg(F.collect_list("fp").alias("fps")))
    again = posted.join(large, "key", "left_semi").select(
        F.explode(
            F.filter(
                _keys(F.col("fp"), FIVES),
                lambda k: F.element_at(
                    F.array(*[F.array(*[F.lit(set(t) <= set(f)) for t in THREES]) for f in FIVES]), k["set"] + 1
                )[F.col("key.set")],
            )
        ).alias("key"),
        "fp",
    )
    fives = again.distinct().groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return links.unionByName(_links(fives))


def _by_print(prints: DataFrame) -> DataFrame:
    """(fp, first) for each distinct fingerprint; first is (doc_id, text_key) of its component's first document."""
    # Null ids come last; the minimum is combined before the shuffle.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    distinct = stored(prints.groupBy("fp").agg(first), "fingerprint_groups")
    roots = components(near_links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    grouped = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("first").alias("first"))
    return grouped.select("root", "fp").join(least, "root").select("fp", "first")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    prints = stored(fingerprints(docs), "fingerprints")
    return prints.join(_by_print(prints), "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def keep_rows(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, text_key) of ``stay``."""
    rows = packed(docs).select("doc_id", F.xxhash64("text").alias("text_key"), ROW).alias("r")
    same = F.expr("r.doc_id <=> s.doc_id and r.text_key = s.text_key")
    kept = rows.join(stay.alias("s"), same, "left_semi")
    one = Window.partitionBy("doc_id", "text_key").orderBy(F.lit(0))
    return kept.withColumn("place", F.row_number().over(one)).where("place = 1").select(f"{ROW}.*")


def near_distinct(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id (then smallest text hash)."""
    prints = stored(fingerprints(docs), "fingerprints")
    return keep_rows(docs, _by_print(prints).select("first.doc_id", "first.text_key").distinct())


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
