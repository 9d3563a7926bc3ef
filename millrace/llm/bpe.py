"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over code points cuts each text where its content says so, so passages that
documents share give the same chunks wherever they stand.  Each chunk is encoded once per task
(a bounded memory of chunks); at each join the text around it is encoded again, and the window
grows until one of its pre-token borders agrees with a border of the next chunk.  From such a border
on both encodings are the same, because a pre-token depends only on the text that follows its start.

Defined results: a null text is empty and has no ids; rows are handled one by one, so repeated
rows, null ids, other columns and empty tables need nothing special.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts
from millrace.llm.tokens import Encoder, encoder

WINDOW = 8
MEAN_BITS = 10
SHORTEST, LONGEST = 256, 16_384
STEP = np.uint32(0x9E3779B1)
# A pre-token is settled by at most this many code points after its end.
AHEAD = 4
MEMORY = 48 << 20


def cuts(text: str) -> list[int]:
    """Chunk ends: where the hash of the last WINDOW code points has MEAN_BITS leading zeros."""
    if len(text) <= max(SHORTEST, WINDOW):
        return [len(text)]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    size = len(codes) - WINDOW + 1
    rolled = np.zeros(size, np.uint32)
    for k in range(WINDOW):
        rolled *= STEP
        rolled += codes[k : size + k]
    rolled *= STEP
    ends, last = [], 0
    for end in (np.flatnonzero(rolled >> np.uint32(32 - MEAN_BITS) == 0) + WINDOW).tolist():
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end - last >= SHORTEST:
            ends.append(end)
            last = end
    while len(text) - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if last < len(text):
        ends.append(len(text))
    return ends


class ChunkEncoder:
    """Encodes texts chunk by chunk; ``hits`` counts chunks that had been encoded before."""

    def __init__(self, words: Encoder, memory: int = MEMORY):
        self.words, self.memory = words, memory
        self.known: dict[str, tuple[list[int], list[int], bytes]] = {}
        self.held = self.hits = self.chunks = 0

    def chunk(self, text: str) -> tuple[list[int], list[int], bytes]:
        """(pre-token ends in code points, in bytes of ids, ids); no chunk is encoded twice while remembered."""
        self.chunks += 1
        found = self.known.get(text)
        if found is not None:
            self.hits += 1
            return found
        found = self._encode(text)
        cost = len(text) * 2 + len(found[2]) + 72 * len(found[0])
        if self.held + cost > self.memory:
            self.known.clear()
            self.held = 0
        self.known[text] = found
        self.held += cost
        return found

    def _encode(self, text: str) -> tuple[list[int], list[int], bytes]:
        words = self.words.words(text)
        ids = list(map(self.words.__getitem__, words))
        return (
            np.cumsum(list(map(len, words)), dtype=np.int64).tolist(),
            np.cumsum(list(map(len, ids)), dtype=np.int64).tolist(),
            b"".join(ids),
        )

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        for place, part in enumerate(self.words.segments(text)):
            if place % 2:
                out.append(self.words.added_id(part))
            elif part:
                self._encode_part(part, out)
        return b"".join(out)

    def _encode_part(self, text: str, out: list[bytes]) -> None:
        ends = cuts(text)
        start = 0
        chars, places, ids = self.chunk(text[: ends[0]])
        # All text before code point `sure` of the current chunk is settled; its ids up to `given` are in out.
        given = sure = 0
        for k in range(1, len(ends)):
            stop = ends[k - 1]
            after = self.chunk(text[stop : ends[k]])
            # The last border of this chunk that the cut cannot have moved.
            left, left_ids = sure, given
            for n in range(len(chars) - 1, -1, -1):
                if chars[n] < sure:
                    break
                if chars[n] <= stop - start - AHEAD:
                    left, left_ids = chars[n], places[n]
                    break
            out.append(ids[given:left_ids])
            window_ids, sure, given = self._repair(text, start + left, stop, ends[k], after)
            if sure is None:  # no agreement within the next chunk: it is encoded again with what is before it
                chars, places, ids = self._encode(text[start + left : ends[k]])
                start, sure, given = start + left, 0, 0
                continue
            out.append(window_ids)
            (chars, places, ids), start = after, stop
        out.append(ids[given:])

    def _repair(self, text: str, left: int, stop: int, end: int, after) -> tuple[bytes, int | None, int | None]:
        """Ids from ``left`` up to the first border in the chunk [stop, end) on which both encodings agree."""
        chars, places, _ = after
        last_chunk = end == len(text)
        reach = 4
        while True:
            whole = reach >= len(chars)
            edge = stop + (chars[-1] if whole else chars[reach - 1])
            words = self.words.words(text[left:edge])
            borders, at = {}, left
            for n, word in enumerate(words):
                at += len(word)
                borders[at] = n + 1
            limit = edge if whole and last_chunk else edge - AHEAD
            for n in range(min(reach, len(chars))):
                border = stop + chars[n]
                if border > limit:
                    break
                if border in borders:
                    kept = words[: borders[border]]
                    return b"".join(map(self.words.__getitem__, kept)), chars[n], places[n]
            if whole:
                return b"", None, None
            reach *= 4


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of each text's ids and of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        chunks = ChunkEncoder(words)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in texts(batch):
                ids = chunks.encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(words.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op10_bpe_chunks(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json")
    )
