"""Toxicity by a weighted lexicon matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digit substitutions to a-z and drops
marks that hide inside words.  The lexicon's weights are log-odds of documents with a word, learned from
labelled rows.  All words and the exception phrases stand in one automaton; words inside an exception
phrase do not count.  The feature of a text is the sum of its matches' weights over a length norm, and
a logistic curve fitted on the training rows turns it into a score.

TRAIN_ROWS labelled rows, the first by a hash of their id, bound what is learned from; LEXICON bounds
the words kept.  Scores use all of every text.

Defined results: a null or empty text has no matches and gets the curve's value at zero; null labels and labels other than 0 and 1 are
not learned from, a document with several labels takes the largest; rows are scored one by one, so repeated rows
and ties need nothing special; a null doc_id is not held out; without training rows every score is 0;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, texts

TRAIN_ROWS = 40_000
LEXICON = 2_000
# A lexicon entry is a whole word, or a stem: the first letters of inflected words.
STEMS = (4, 5, 6)
LEAST_DOCS = 3
LEAST_Z = 6.0
LEAST_ODDS = 3.0
THRESHOLD = 0.3
# Texts shorter than this count as this long.
NORM_WORDS = 64

# Letters of other scripts and signs read as a Latin letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
# Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "circus clown", "pond scum", "sore loser rule", "stupid simple")

FOLD = str.maketrans(LOOK_ALIKES | dict.fromkeys("­​‌‍⁠﻿"))
GAPS = re.compile("[^a-z]+")


def fold(text: str) -> str:
    """Words of a-z, one space between and around them."""
    text = text.lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    return f" {GAPS.sub(' ', text.translate(FOLD)).strip()} "


def entries(folded: str) -> set[str]:
    """Lexicon entries that a folded text could match: words end in a space, stems do not."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in STEMS if len(w) > n}


class Lexicon:
    """Weighted words, weighted stems and exception phrases in one automaton."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for word, weight in weights.items():
            self.machine.add_word(word, (len(word), weight))
        for phrase in exceptions:
            folded = fold(phrase)
            self.machine.add_word(folded, (len(folded), None))
        self.empty = not len(self.machine)
        self.machine.make_automaton()

    def feature(self, text: str) -> float:
        if self.empty:
            return 0.0
        folded = fold(text)
        best: dict[int, float] = {}
        harmless = []
        for end, (size, weight) in self.machine.iter(folded):
            start = end - size + 1
            if weight is None:
                harmless.append((start, end))
            else:  # one match per word, the heaviest
                best[start] = max(weight, best.get(start, weight))
        # A word counts unless it starts inside a phrase.
        harmless.sort()
        starts = [a for a, _ in harmless]
        reach = list(accumulate((b for _, b in harmless), max))
        total = 0.0
        for at, weight in best.items():
            k = bisect_right(starts, at) - 1
            if k < 0 or reach[k] <= at:
                total += weight
        # A square root: a few matches must show in a long text too.
        return total / math.sqrt(max(NORM_WORDS, folded.count(" ") - 1) / NORM_WORDS)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents that are not held out."""
    known = labels.where("doc_id is not null and cast(toxic as int) in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most ``rows`` pairs of numbers are broadcast.
    found = texts_.join(F.broadcast(known), "doc_id").select("text", "toxic")
    # Equal texts count once, so that a group of copies does not teach its own words.
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    return found.groupBy(key.alias("key")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("key")


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Log-odds of the words and stems that mark toxic documents, the strongest ``size`` by z-score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                for word in entries(fold(text)):
                    counts.setdefault(word, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(counts, pa.string()),
                    "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
                    "toxic": pa.array([c[1] for c in counts.values()], pa.int64()),
                }
            )

    clean, toxic = rows.agg(F.sum(1 - F.col("toxic")), F.sum("toxic")).first()
    if not clean or not toxic:
        return {}
    words = rows.select("text", "toxic").mapInArrow(run, "word string, clean long, toxic long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    # Never zero: a word may stand in every text.
    error = F.greatest(F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean)), F.lit(1e-9))
    excess = F.col("toxic") / toxic - F.col("clean") / clean
    best = (
        words.groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= LEAST_DOCS)
        .select("word", odds.alias("odds"), (excess / error).alias("z"))
        .where((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("z"), "word")
        .limit(size)
    )
    return {r["word"]: r["odds"] for r in best.collect()}


def features(rows: DataFrame, weights: dict[str, float], keep: str) -> DataFrame:
    """``keep`` (a long column) and the feature of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            values = [lexicon.feature(text) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(values, pa.float64())], names=[keep, "feature"])

    return rows.select(F.col(keep).cast("long").alias(keep), "text").mapInArrow(run, f"{keep} long, feature double")


def fit_curve(counts: list[tuple[float, float, float]], steps: int = 50) -> tuple[float, float]:
    """(intercept, slope) of a logistic curve over (feature, clean rows, toxic rows), with a weak ridge."""
    x, clean, toxic = (np.array(c, float) for c in zip(*counts))
    beta, design = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        weight = (clean + toxic) * p * (1 - p)
        gradient = design.T @ (toxic - (clean + toxic) * p) - 1e-2 * beta
        move = np.linalg.solve(design.T @ (design * weight[:, None]) + 1e-2 * np.eye(2), gradient)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``."""
    train = stored(training(docs, labels, rows), "toxicity_training")
    weights = learn_lexicon(train)
    # Square roots in quarters: a bounded table, fine where the curve is steep.
    level = F.least(F.round(F.sqrt("feature") * 4), F.lit(400.0))
    binned = (
        features(train, weights, "toxic")
        .groupBy(level.alias("level"))
        .agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
        .orderBy("level")
        .collect()
    )
    cut, slope = fit_curve([tuple(r) for r in binned]) if binned else (-30.0, 0.0)
    value = F.lit(cut) + F.lit(slope) * F.least(F.sqrt("feature") * 4, F.lit(400.0))
    rated = features(docs, weights, "doc_id").withColumn("score", 1 / (1 + F.exp(-value)))
    return rated.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    read = spark.read.parquet
    return score(read(f"{sf_dir}/documents.parquet"), read(f"{sf_dir}/labels.parquet"))
