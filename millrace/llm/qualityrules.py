"""Quality rules: fixed counts and a calibrated logistic regression over hashed word and character n-grams.

Fixed counts fail a text first (too few words, too many words in repeated three-word windows).  The others are scored
by a logistic regression over hashed word n-grams (one and two words) and character n-grams (three
and four bytes): the mean weight of a text's word grams plus the mean weight of its character grams plus a constant.
Weights are learned from labelled rows, a probability from other labelled rows (a sigmoid over the score), and texts
whose probability of being good is below KEEP are rejected.  Scoring runs in Arrow batches: the grams of many texts
are hashed and weighed at once.

TRAIN_ROWS labelled rows fit the weights and CALIBRATE_ROWS others the probability, the first by a hash of doc_id;
every row and whole text is counted and scored.  Without labels of both kinds only the fixed counts decide.

Defined results: a null or empty text has no words and fails; doc_id, lang and source are no inputs; labels other than 0
and 1, without doc_id or of rows that do not exist are left out, of a row labelled both ways the 0 counts, of rows that
share a doc_id the least text is learned from; rows are scored one by one, so repeated rows, ties and null ids need
nothing special; an empty table gives no rows; other columns of any name are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The symbols counted, and the counts that fail a text.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED = (50, 100)
KEEP = 0.5

TRAIN_ROWS = 2_000
CALIBRATE_ROWS = 1_000
BITS = 14
STEPS, RATE, SHRINK = 80, 0.5, 2e-7
SLICE_BYTES = 1 << 21
BREAKS = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
WIDTHS = (3, 4)
# A whole number with an inverse modulo 2 ** 64 (odd), and one to mix the bits of a hash.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xBF58476D1CE4E5B9)
INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))


# --- fixed counts -----------------------------------------------------------------------


def counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text in UTF-8."""
    words = data.split()
    lines = Counter(line for line in data.split(b"\n") if line.strip())
    return (
        len(words),
        len(b"".join(words).decode()),
        len(data) - len(data.translate(None, SYMBOLS)),
        sum(lines.values()) - len(lines),
        repeated_words(words),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often, covered, end = Counter(windows), 0, 0
    for place, window in enumerate(windows):
        if often[window] > 1:
            covered += place + 3 - max(end, place)
            end = place + 3
    return covered


def fails(n_words: int, n_repeat_words: int) -> bool:
    share, whole = MOST_REPEATED
    return n_words < MIN_WORDS or whole * n_repeat_words > share * n_words


# --- grams ------------------------------------------------------------------------------


def _buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ hashes >> np.uint64(31)) * MIX
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def word_grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of the one- and two-word grams of texts that begin at ``starts`` in ``data``.

    A word's hash is the sum of its bytes times powers of STEP, taken from running sums.
    """
    inner = ~BREAKS[data]
    edges = np.diff(np.concatenate([[0], inner.view(np.int8), [0]]))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    powers = np.cumprod(np.full(len(data), STEP))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    back = np.cumprod(np.full(len(data), INVERSE))
    words = (sums[last] - sums[first]) * back[first]
    owner = np.searchsorted(starts, first, "right") - 1
    together = owner[1:] == owner[:-1]
    pairs = (words[:-1] * MIX + words[1:])[together]
    return (
        np.concatenate([_buckets(words), _buckets(pairs)]),
        np.concatenate([owner, owner[1:][together]]),
    )


def char_grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of the byte grams of texts that begin at ``starts`` and end before a 0."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))
    found, owners = [], []
    for width in WIDTHS:
        if len(data) < width:
            continue
        codes = data[: len(data) - width + 1].astype(np.uint64) + np.uint64(width << 40)
        for k in range(1, width):
            codes |= data[k : len(data) - width + 1 + k].astype(np.uint64) << np.uint64(8 * k)
        # a gram may not reach over the 0 between two texts
        whole = owner[: len(codes)] == owner[width - 1 :]
        whole &= data[width - 1 :] != 0
        found.append(_buckets(codes * STEP)[whole])
        owners.append(owner[: len(codes)][whole])
    return (
        (np.concatenate(found), np.concatenate(owners)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
    )


def slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts as byte arrays of about SLICE_BYTES with the place where each begins; a text stays whole."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < SLICE_BYTES):
            size += len(texts[end]) + 1
            end += 1
        # A text's own 0 bytes become spaces: 0 marks its end.
        data = np.frombuffer(b"\0".join([*(t.replace(b"\0", b" ") for t in texts[at:end]), b""]), np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])[:-1]
        yield data, starts
        at = end


def text_words(data: np.ndarray) -> np.ndarray:
    """The same bytes with the ends of texts as breaks between words."""
    return np.where(data == 0, np.uint8(32), data)


def scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """The linear score of each text; ``weights``: word buckets, character buckets, constant."""
    out = []
    for data, starts in slices(texts):
        total = np.full(len(starts), float(weights[-1]))
        for grams, table in ((word_grams(text_words(data), starts), 0), (char_grams(data, starts), 1)):
            bucket, owner = grams
            sums = np.bincount(owner, weights[bucket + (table << BITS)], len(starts))
            total += sums / np.maximum(np.bincount(owner, minlength=len(starts)), 1)
        out.append(total)
    return np.concatenate(out) if out else np.empty(0)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, share) of one text: what its score multiplies the weights with, but for the constant."""
    ((data, starts),) = slices([text])
    buckets, shares = [], []
    for grams, table in ((word_grams(text_words(data), starts), 0), (char_grams(data, starts), 1)):
        bucket, n = np.unique(grams[0], return_counts=True)
        buckets.append(bucket + (table << BITS))
        shares.append(n / max(len(grams[0]), 1))
    return np.concatenate(buckets), np.concatenate(shares)


# --- learning ---------------------------------------------------------------------------


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by adaptive gradient steps over all rows; both kinds weigh alike."""
    size = (2 << BITS) + 1
    bucket = np.concatenate([b for b, _ in rows])
    share = np.concatenate([s for _, s in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(b) for b, _ in rows])
    balance = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    weights, squares = np.zeros(size), np.full(size, 1e-12)
    for _ in range(STEPS):
        margin = np.bincount(owner, weights[bucket] * share, len(rows)) + weights[-1]
        slope = balance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - good)
        gradient = np.bincount(bucket, slope[owner] * share, size) + SHRINK * weights
        gradient[-1] = slope.sum()
        squares += gradient**2
        weights -= RATE * gradient / np.sqrt(squares)
    return weights


def calibrate(score: np.ndarray, good: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(slope, offset) of the sigmoid that turns scores into probabilities, by Newton steps."""
    slope, offset = 1.0, 0.0
    # Labels are taken as a little unsure, which keeps the slope finite.
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * score + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * score).sum(), (p - target).sum()])
        h = np.array([[(w * score**2).sum() + 1e-6, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
        slope, offset = slope - move[0], offset - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(slope), float(offset)


def learn(docs: DataFrame, labels: DataFrame, train: int = TRAIN_ROWS, calibrating: int = CALIBRATE_ROWS):
    """(weights, slope, offset) from at most ``train`` + ``calibrating`` labelled rows; None without both kinds."""
    place = F.xxhash64("doc_id")
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
        .where("doc_id is not null and good in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("good").alias("good"))
    )
    chosen = known.withColumn("place", place).orderBy("place", "doc_id").limit(train + calibrating)
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("place", "doc_id", "good")
        .agg(F.min("text").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py().encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("place"),
                    batch.column("doc_id"),
                    batch.column("good"),
                    pa.array([b.astype("<u2").tobytes() for b, _ in rows], pa.binary()),
                    pa.array([s.astype("<f4").tobytes() for _, s in rows], pa.binary()),
                ],
                names=["place", "doc_id", "good", "bucket", "share"],
            )

    found = sample.mapInArrow(run, "place long, doc_id long, good int, bucket binary, share binary").toPandas()
    found = found.sort_values(["place", "doc_id"])
    good = found["good"].to_numpy(bool)
    rows = [
        (np.frombuffer(b, "<u2").astype(np.int32), np.frombuffer(s, "<f4"))
        for b, s in zip(found.pop("bucket"), found["share"], strict=True)
    ]
    # The share of rows kept for calibration is the same for few labels as for many.
    cut = len(rows) * train // (train + calibrating)
    if len({*good[:cut]}) < 2 or len({*good[cut:]}) < 2:
        return None
    weights = fit(rows[:cut], good[:cut])
    held = np.array([weights[b] @ s + weights[-1] for b, s in rows[cut:]])
    return weights, *calibrate(held, good[cut:])


# --- rows -------------------------------------------------------------------------------

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, p_good double"
)
BATCH_ROWS = 512


def judge(docs: DataFrame, labels: DataFrame, train: int = TRAIN_ROWS, calibrating: int = CALIBRATE_ROWS) -> DataFrame:
    """Counts, probability of being good (null where there is no model) and verdict of each row."""
    model = learn(docs, labels, train, calibrating)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [(t.as_py() or "").encode() for t in part.column("text")]
                numbers = np.array([counts(t) for t in texts], np.int64).reshape(-1, 5)
                failed = np.array([fails(n, r) for n, r in numbers[:, (0, 4)].tolist()], bool)
                p = None
                kept = ~failed
                if model is not None:
                    weights, slope, offset = model
                    p = 1 / (1 + np.exp(-np.clip(slope * scores(texts, weights) + offset, -30, 30)))
                    kept &= p >= KEEP
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(numbers[:, k]) for k in range(5)],
                        pa.array(failed, pa.bool_()),
                        pa.array(kept, pa.bool_()),
                        pa.nulls(len(texts), pa.float64()) if p is None else pa.array(p, pa.float64()),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op12_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return judge(docs, labels)
