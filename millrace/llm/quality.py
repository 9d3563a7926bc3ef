"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on each text.  Expectation-maximisation over the counts of
vote patterns (one aggregate over all documents, at most 3 ** len(LABELLERS) rows) estimates
how often each labeller is right in each class and gives a posterior per pattern.  Posterior labels then train a linear scorer
over hashed features (word shapes, their pairs, short words).  The scorer, not the votes, judges documents.

TRAIN_ROWS documents, the first by a hash of text, bound what the scorer is fitted on; the votes and the
scores cover all rows and whole texts.  Equal texts get equal scores.

Defined results: a null or empty text has no features, scores 0 and is rejected; rows are judged one by one, so
repeated rows, ties and null ids need nothing special; an empty table gives no rows; other columns of any name
pass through :func:`keep_good` unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, packed, row_texts, stored, texts

TRAIN_ROWS = 8_192
BITS = 14
THRESHOLD = 0.5
EPOCHS = 12
# Labellers abstain on texts with fewer words.
LEAST_WORDS = 8

LETTER_RUN = re.compile(r"[^\W\d_]+")
DIGIT_RUN = re.compile(r"\d+")
WORD = re.compile(r"\S+")


def _band(value: float, bad_from: float, good_to: float) -> int:
    """1 (good) up to ``good_to``, 0 (bad) from ``bad_from``, -1 (abstain) between."""
    return 1 if value <= good_to else 0 if value >= bad_from else -1


def votes(text: str) -> list[int]:
    """The labellers' votes on a text: 1 good, 0 bad, -1 abstain."""
    words = text.split()
    if not words:
        return [0] * len(LABELLERS)
    if len(words) < LEAST_WORDS:
        return [-1] * len(LABELLERS)
    chars = sum(map(len, words))
    runs = LETTER_RUN.findall(text)
    letters = sum(map(len, runs))
    lines = [line for line in text.split("\n") if line.strip()]
    lonely = sum(1 for w in words if not w.isalnum() and not any(map(str.isalnum, w)))
    short = sum(1 for w in words if len(w) <= 3 and w.isalpha() and w.islower())
    tails = sum(1 for w in words if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum())
    stutter = sum(map(str.__eq__, words, words[1:]))
    repeated = 1 - len(set(lines)) / len(lines)
    return [
        _band(1 - letters / chars, 0.20, 0.10),
        _band(lonely / len(words), 0.10, 0.02),
        _band(tails / len(words), 0.20, 0.05),
        _band(-short / len(words), -0.05, -0.15),
        _band(letters / max(1, len(runs)), 9.0, 7.0),
        _band(repeated, 0.5, 0.1) if len(lines) > 2 else -1,
        _band(stutter / len(words), 0.15, 0.02),
    ]


# Names of the labellers, in the order of their votes.
LABELLERS = ("few_symbols", "few_lone_symbols", "plain_word_ends", "function_words", "word_length", "distinct_lines", "no_stutter")


def estimate(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Posterior of "good" per vote pattern, by expectation-maximisation over pattern counts.

    Each class has its own vote distribution per labeller; it starts from the majority vote, which also
    fixes which class is the good one.
    """
    if not patterns:
        return {}
    seen = np.array([p for p, _ in patterns]) + 1
    count = np.array([n for _, n in patterns], float)
    one_hot = np.eye(3)[seen]  # pattern, labeller, vote
    good, bad = one_hot[:, :, 2].sum(axis=1), one_hot[:, :, 1].sum(axis=1)
    post = np.clip((good + 0.5) / (good + bad + 1.0), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([count * (1 - post), count * post])
        table = np.einsum("cp,plv->clv", weight, one_hot) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (count.sum() + 2)
        score = np.log(prior)[:, None] + np.einsum("plv,clv->cp", one_hot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return {p: float(v) for (p, _), v in zip(patterns, post, strict=True)}


class Remembered(dict):
    """Values of a function by key, forgotten as a whole when there are ``most`` of them."""

    def __init__(self, make, most: int = 1 << 16):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _slot(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature, 7) >> (32 - BITS)


def _shape(word: str) -> str:
    return DIGIT_RUN.sub("0", LETTER_RUN.sub("a", word))[:12] if len(word) <= 64 else "long"


SHAPES = Remembered(_shape)
SHAPE_SLOTS = Remembered(_slot)
PAIR_SLOTS = Remembered(lambda pair: _slot(" ".join(pair)))
SHORT_SLOTS = Remembered(lambda word: _slot("=" + word.lower()))
SAME_SLOT = _slot("same")
BLOCK_WORDS = 1 << 16


def _word_blocks(text: str) -> Iterator[list[str]]:
    """The words of a text, at most BLOCK_WORDS at a time."""
    if len(text) < 4 * BLOCK_WORDS:
        words = WORD.findall(text)
        if words:
            yield words
        return
    found = WORD.finditer(text)
    while words := [match.group() for match in islice(found, BLOCK_WORDS)]:
        yield words


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a text, of unit length; memory grows with a block of words, not with the text."""
    counts = np.zeros(1 << BITS)
    before, last = "^", ""
    for words in _word_blocks(text):
        # letters alone need no pattern, and long words are not worth remembering
        shapes = ["long" if len(word) > 64 else "a" if word.isalpha() else SHAPES[word] for word in words]
        slots = [SHAPE_SLOTS[shape] for shape in shapes]
        slots += [PAIR_SLOTS[pair] for pair in zip([before, *shapes], shapes, strict=False)]
        slots += [SHORT_SLOTS[word] for word in words if len(word) <= 4]
        counts += np.bincount(slots, minlength=1 << BITS)
        counts[SAME_SLOT] += sum(map(str.__eq__, [last, *words], words))
        before, last = shapes[-1], words[-1]
    slots = np.flatnonzero(counts)
    values = np.sqrt(counts[slots])
    return slots, values / max(1e-12, np.sqrt((values**2).sum()))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, intercept) of a logistic scorer on soft labels, by adaptive gradient steps over rows in order."""
    weights, squares, cut, cut_square = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        for slots, values, target in rows:
            error = 1 / (1 + np.exp(-np.clip(values @ weights[slots] + cut, -30, 30))) - target
            step = error * values
            squares[slots] += step**2
            weights[slots] -= 0.5 * step / np.sqrt(squares[slots])
            cut_square += error**2
            cut -= 0.5 * error / np.sqrt(cut_square)
    return weights, float(cut)


VOTED = "key long, votes string"


def vote_table(docs: DataFrame) -> DataFrame:
    """(key, votes) of each row; key is a hash of the text, votes a string of one sign per labeller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = ["".join("-01"[v + 1] for v in votes(text)) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(signs, pa.string())], names=["key", "votes"])

    return docs.select(_text_key().alias("key"), "text").mapInArrow(run, VOTED)


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The fitted scorer: one vote pass over all documents, one fit on at most ``rows`` texts."""
    voted = stored(vote_table(docs), "votes")
    counts = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    posterior = estimate([(tuple("-01".index(c) - 1 for c in r["votes"]), r["n"]) for r in counts])
    # The smallest hashes: a fixed choice that does not depend on how rows are partitioned.
    chosen = voted.groupBy("key").agg(F.min("votes").alias("votes")).orderBy("key").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("votes"),
                    pa.array([s.astype(np.int32) for s, _ in found], pa.list_(pa.int32())),
                    pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                ],
                names=["key", "votes", "slots", "vals"],
            )

    # At most ``rows`` pairs are broadcast and as many feature rows collected.
    picked = docs.select(_text_key().alias("key"), "text").join(F.broadcast(chosen), "key")
    sample = picked.mapInArrow(run, "key long, votes string, slots array<int>, vals array<float>")
    sample = sample.groupBy("key").agg(F.first("votes").alias("votes"), F.first("slots").alias("slots"), F.first("vals").alias("vals"))
    table = sample.orderBy("key").toArrow()
    examples = [
        (np.array(s, np.int64), np.array(v, np.float64), posterior[tuple("-01".index(c) - 1 for c in p)])
        for s, v, p in zip(table["slots"].to_pylist(), table["vals"].to_pylist(), table["votes"].to_pylist(), strict=True)
    ]
    return fit(examples)


def scorer(weights: np.ndarray, cut: float):
    def score(text: str) -> float:
        if not text or text.isspace():
            return 0.0
        slots, values = features(text)
        return float(1 / (1 + np.exp(-np.clip(values @ weights[slots] + cut, -30, 30))))

    return score


def report(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, score (0 to 1) and kept (score >= THRESHOLD) of each row."""
    model = train(docs, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(*model)
        for batch in batches:
            values = pa.array([score(text) for text in texts(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "score"])

    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rated.withColumn("kept", F.col("score") >= THRESHOLD)


def keep_good(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the scorer does not reject."""
    model = train(docs, rows)
    whole = packed(docs).select(ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(*model)
        for batch in batches:
            yield batch.filter(pa.array([score(text) >= THRESHOLD for text in row_texts(batch)], pa.bool_()))

    return whole.mapInArrow(run, whole.schema).select(f"{ROW}.*")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
