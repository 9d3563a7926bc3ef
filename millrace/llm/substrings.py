"""Substring dedup with fixed-block anchors.

A repeat of WINDOW = 2 * BLOCK - 1 words contains exactly one whole block of BLOCK words that starts at a multiple
of BLOCK.  So the non-overlapping blocks of all documents are the index, every rolling window of BLOCK words
probes it, and hits are extended: each window of WINDOW words around a hit is compared with all
others by its hash, which gives the maximal exact repeats as unions of repeated windows.

Probes travel as packed arrays dealt by hash into buckets whose number grows with the input, never as pairs:
a bucket answers which of its probes meet a block, so a passage in a third of all documents costs one
entry per occurrence.  Answers come back as positions per text.  Probes compare 32 bits besides the bucket (a false
hit only costs a comparison); windows are compared by 64 bits.

Defined results: a null or empty text has no words; documents of under WINDOW words are left as they are; equal
texts (repeated rows too) repeat each other; null ids stay null; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 18
WINDOW = 2 * BLOCK - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
# Probes per bucket, and entries that a task holds before it deals them out.
BUCKET_ROWS = 4_000_000
FLUSH = 2_000_000
PROBE, EXACT = np.dtype("<u4"), np.dtype("<u8")


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each window of ``size`` words."""
    count = len(words) - size + 1
    out = np.zeros(max(0, count), np.uint64)
    for k in range(size if count > 0 else 0):
        out *= BASE
        out += words[k : k + count]
    # Mixed so that any of the bits can serve as a bucket.
    out ^= out >> np.uint64(32)
    out *= BASE
    out ^= out >> np.uint64(29)
    return out


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    parts = text.encode().split()
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


class Dealer:
    """Collects (hash, text key, position) entries and deals them into one packed row per bucket."""

    def __init__(self, bits: int, entry: np.dtype):
        self.bits, self.entry = bits, entry
        self.clear()

    def clear(self) -> None:
        self.keys, self.hashes, self.docs, self.positions, self.held = [], [], [], [], 0

    def add(self, key: int, hashes: np.ndarray, positions: np.ndarray) -> None:
        self.hashes.append(hashes)
        self.positions.append(positions.astype(np.uint32))
        self.docs.append(np.full(len(hashes), len(self.keys), np.uint32))
        self.keys.append(key)
        self.held += len(hashes)

    def deal(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            hashes = np.concatenate(self.hashes)
            buckets = (hashes >> np.uint64(64 - self.bits)).astype(np.int32)
            order = np.argsort(buckets, kind="stable")
            # The top bits are the bucket; a narrow entry keeps the lowest ones.
            hashes = hashes.astype(self.entry)[order]
            docs, places = np.concatenate(self.docs)[order], np.concatenate(self.positions)[order]
            keys = np.array(self.keys, np.int64)
            found, starts = np.unique(buckets[order], return_index=True)
            out = []
            for bucket, start, stop in zip(found.tolist(), starts, [*starts[1:], len(order)], strict=True):
                used, counts = np.unique(docs[start:stop], return_counts=True)
                steps = pack_steps(counts, places[start:stop])
                out.append((bucket, keys[used].tobytes(), hashes[start:stop].tobytes(), steps))
            yield _batch(out, ("bucket", "keys", "hashes", "steps"), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))
        self.clear()


def pack_steps(counts: np.ndarray, places: np.ndarray) -> bytes:
    """Entries per text and their rising positions, as compressed byte planes of counts and steps."""
    steps = np.diff(places.astype(np.int64), prepend=0)
    firsts = np.cumsum(counts) - counts
    steps[firsts] = places[firsts]
    numbers = np.concatenate([counts, steps]).astype("<u4")
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack_steps(data: bytes, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, positions) of :func:`pack_steps`."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    counts, steps = numbers[:texts], numbers[texts:]
    total = np.cumsum(steps)
    firsts = np.cumsum(counts) - counts
    return counts, (total - np.repeat(total[firsts] - steps[firsts], counts)).astype(np.uint32)


def _batch(rows: list[tuple], names: tuple, types: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


DEALT = "bucket int, keys binary, hashes binary, steps binary"
ANSWER = "key long, positions binary"


def _probes(docs: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, dealer = WordHashes(), Dealer(bits, PROBE)
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                words = word_hashes(text.as_py(), known)
                if len(words) >= WINDOW:
                    hashes = rolling(words, BLOCK)
                    dealer.add(key, hashes, np.arange(len(hashes)))
                    if dealer.held > FLUSH:
                        yield from dealer.deal()
        yield from dealer.deal()

    return docs.select("key", "text").mapInArrow(run, DEALT)


def _windows(docs: DataFrame, bits: int) -> DataFrame:
    """Windows of WINDOW words that hold a hit; ``docs`` has (doc_id, key, body, hits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, dealer = WordHashes(), Dealer(bits, EXACT)
        for batch in batches:
            columns = (batch.column("key").to_pylist(), batch.column("body"), batch.column("hits"))
            for key, body, hits in zip(*columns, strict=True):
                if not hits.is_valid:
                    continue
                hashes = rolling(word_hashes(_text(body), known), WINDOW)
                near = _cover(_positions(hits.as_py()) - (WINDOW - BLOCK), WINDOW - BLOCK + 1, len(hashes))
                places = np.flatnonzero(near)
                dealer.add(key, hashes[places], places)
                if dealer.held > FLUSH:
                    yield from dealer.deal()
        yield from dealer.deal()

    return docs.mapInArrow(run, DEALT)


def _bodies(rows: DataFrame) -> DataFrame:
    """(doc_id, key, body): the texts compressed, as they are shuffled whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            bodies = pa.array([squeeze(text.as_py().encode()) for text in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), bodies], names=["doc_id", "key", "body"]
            )

    return rows.mapInArrow(run, "doc_id long, key long, body binary")


def _text(body: pa.Scalar) -> str:
    return zstandard.decompress(body.as_py()).decode()


def _positions(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64)


def _cover(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Boolean array of ``length``: within ``size`` from one of the starts."""
    edges = np.zeros(length + 1, np.int64)
    np.add.at(edges, np.clip(starts, 0, length), 1)
    np.add.at(edges, np.clip(starts + size, 0, length), -1)
    return np.cumsum(edges)[:length] > 0


def _answers(dealt: DataFrame, entry: np.dtype, anchored: bool) -> DataFrame:
    """Positions whose hash occurs at least twice in the bucket (``anchored``: once at a block's start)."""

    def run(table: pa.Table) -> pa.Table:
        hashes, keys, places = [], [], []
        columns = (table.column("keys"), table.column("hashes"), table.column("steps"))
        for own, some, steps in zip(*columns, strict=True):
            own = np.frombuffer(own.as_py(), "<i8")
            counts, at = unpack_steps(steps.as_py(), len(own))
            hashes.append(np.frombuffer(some.as_py(), entry))
            keys.append(np.repeat(own, counts))
            places.append(at)
        hashes, keys, places = np.concatenate(hashes), np.concatenate(keys), np.concatenate(places)
        _, group, sizes = np.unique(hashes, return_inverse=True, return_counts=True)
        good = sizes >= 2
        if anchored:
            good &= np.bincount(group, places % BLOCK == 0, len(sizes)) > 0
        rows = good[group]
        # Equal texts give equal answers, so each (key, position) is told once.
        pairs = np.unique(np.rec.fromarrays([keys[rows], places[rows]], names="key,pos"))
        found, starts = np.unique(pairs["key"], return_index=True)
        told = [p.astype("<u4").tobytes() for p in np.split(pairs["pos"], starts[1:])] if len(found) else []
        return pa.table([pa.array(found.astype(np.int64), pa.int64()), pa.array(told, pa.binary())], names=["key", "positions"])

    # One key per bucket and few, large rows: a bucket holds about BUCKET_ROWS entries at any input size.
    return dealt.groupBy("bucket").applyInArrow(run, ANSWER)


def _by_text(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("key").agg(F.collect_list("positions").alias(name))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # About six characters a word; any estimate gives the same rows.
    bits = max(5, (size // 6 // BUCKET_ROWS).bit_length())
    hits = _by_text(_answers(_probes(rows, bits), PROBE, True), "hits")
    # Both joins take the same columns with the same kind of join, so that one shuffle of the texts serves both.
    bodies = _bodies(rows)
    windows = _windows(bodies.join(hits, "key", "left"), bits)
    repeats = _by_text(_answers(windows, EXACT, False), "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column("doc_id").to_pylist(), batch.column("body"), batch.column("repeats"))
            for doc_id, value, found in zip(*columns, strict=True):
                words = zstandard.decompress(value.as_py()).split()
                gone = _cover(_positions(found.as_py() or []), WINDOW, len(words))
                kept = b" ".join(w for w, out_ in zip(words, gone.tolist(), strict=True) if not out_)
                out.append((doc_id, len(words), int(gone.sum()), kept.decode()))
            yield _batch(out, ("doc_id", "n_words", "n_removed", "kept"), (pa.int64(), pa.int64(), pa.int64(), pa.string()))

    return bodies.join(repeats, "key", "left").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string"
    )


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
