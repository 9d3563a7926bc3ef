"""Personal data by a skip-chain conditional random field.

Fixed patterns give base spans (email, ip, card, phone), which always stay.  Around them a field over the
candidate tokens of a document (those with digits or an ``@``) finds more: each token has a label, tokens covered
by base spans are clamped to theirs, node potentials are learned log-odds of token shapes, chain edges join
neighbours and skip edges join repeated or similar tokens (equal once all but letters and digits is dropped) through a
hub they share.  Loopy message passing in a fixed number of rounds spreads labels over both kinds of edges, in every
document with a free token, in time linear in its length; a free token whose belief in a kind reaches ADD becomes a span of that kind
unless a base span overlaps it.

Node potentials are counted on TRAIN_ROWS texts, the first by a hash of the text, with base spans
as labels; every text is scanned whole.  A token outside them that is linked to one inside, or is a card number or an
address in an odd form, counts as unknown, not as none.  The SHAPES most
frequent shapes that occur twice are learned; any other counts as unseen, for which the shares of all tokens stand.

Defined results: a null or empty text has no spans; rows are handled one by one, so repeated rows, ties and
null ids need nothing special; an empty table gives no rows; other columns of any name pass through
:func:`redact` unread.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ROW, packed, row_texts, texts

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What follows them, written so that a long run of matching characters is passed over once.
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
WHOLE_IP = re.compile("(?<![0-9])" + IP.pattern)

TRAIN_ROWS = 8_192
SHAPES = 4_096
ADD = 0.95
ROUNDS = 40
CHAIN, SKIP = 0.2, 8.0
SETTLED = 1e-6
SHORTEST = 6
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
EDGE = "\"'.,;:!?()[]{}<>|*#&%$"


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = len(text[done:at].rstrip(NAME)) + done
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            spans.append((0, start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    for m in WHOLE_IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return spans


def tokens(text: str) -> list[tuple[int, int]]:
    """Candidate tokens without the punctuation around them."""
    found = []
    for m in TOKEN.finditer(text):
        word = m.group()
        start = m.start() + len(word) - len(word.lstrip(EDGE))
        end = m.end() - (len(word) - len(word.rstrip(EDGE)))
        if start < end:
            found.append((start, end))
    return found


def shape(token: str) -> str:
    """Letters as a, digits as 0, runs of digits shortened to their length class."""
    out = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"[0-9]+", lambda m: "0" * min(len(m.group()), 6), out)


def clamped(spots: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """Label of each token that a base span overlaps (1 + kind), 0 for the others."""
    labels, spans = [0] * len(spots), sorted((a, b, k) for k, a, b in base)
    at = 0
    for n, (start, end) in enumerate(spots):
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        for a, b, kind in spans[at:]:
            if a >= end:
                break
            if start < b:
                labels[n] = 1 + kind
                break
    return labels


def beliefs(nodes: np.ndarray, edges: np.ndarray, strength: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label beliefs by loopy message passing; ``nodes`` holds log potentials, an edge rewards equal labels.

    Messages of a round are computed together.  A repeat is two edges away from any other one, over their hub, and
    messages along weak edges fade by an order of magnitude an edge, so a fixed number of rounds is enough however
    long the document is.
    """
    size, labels = nodes.shape
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    gain = np.exp(np.concatenate([strength, strength]))[:, None] - 1
    message = np.zeros((len(source), labels))

    def total() -> np.ndarray:
        sums = [np.bincount(target, message[:, k], size) for k in range(labels)]
        return nodes + np.stack(sums, axis=1)

    for _ in range(rounds if len(edges) else 0):
        out = total()[source] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(out * gain + out.sum(axis=1, keepdims=True))
        new -= new.max(axis=1, keepdims=True)
        moved = np.abs(new - message).max()
        message = new
        if moved < SETTLED:
            break
    raw = total()
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    return raw / raw.sum(axis=1, keepdims=True)


def bare(token: str) -> str:
    """The letters and digits of a token: what similar tokens have in common."""
    return "".join(filter(str.isalnum, token)).lower()


def links(text: str, spots: list[tuple[int, int]]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(hub of each token or -1, edges, strengths).

    Repeated and similar tokens share one hub, a node of its own after the tokens: a skip edge leads from each of
    them to it, so n repeats have n edges.  Chain edges join neighbours; neighbours that share a hub need none, two
    hubs' tokens are joined once, however often they stand side by side, and the chain edges of one hub share the strength
    of one, so that a word does not become a card by standing beside many.
    """
    keys = [bare(text[a:b]) for a, b in spots]
    # Short keys repeat by chance and say nothing.
    often = Counter(key for key in keys if len(key) >= SHORTEST)
    hubs: dict[str, int] = {}
    hub = [hubs.setdefault(key, len(spots) + len(hubs)) if often[key] > 1 else -1 for key in keys]
    edges = [(n, h) for n, h in enumerate(hub) if h >= 0]
    strength = [SKIP] * len(edges)
    joined: dict[tuple[int, int], tuple[int, int]] = {}
    for n in range(1, len(spots)):
        if spots[n][0] - spots[n - 1][1] <= 2:
            ends = [h if h >= 0 else m for m, h in ((n - 1, hub[n - 1]), (n, hub[n]))]
            if ends[0] != ends[1]:
                joined.setdefault((min(ends), max(ends)), (n - 1, n))
    degree = Counter(end for pair in joined for end in pair if end >= len(spots))
    for pair, edge in joined.items():
        edges.append(edge)
        strength.append(CHAIN / max(1, degree[pair[0]], degree[pair[1]]))
    return hub, np.array(edges, np.int64).reshape(-1, 2), np.array(strength, float)


def added_spans(text: str, base: list[tuple[int, int, int]], weights: dict[str, list[float]]) -> list[tuple[int, int, int]]:
    spots = tokens(text)
    labels = clamped(spots, base)
    if not spots or all(labels):
        return []
    hub, edges, strength = links(text, spots)
    nothing = [0.0] * (1 + len(KINDS))
    # A shape that was never seen says nothing: the shares of all tokens count, once for all repeats.
    prior = weights.get("", nothing)
    nodes = np.zeros((max([len(spots), *(h + 1 for h in hub)]), 1 + len(KINDS)))
    for n, ((a, b), label, h) in enumerate(zip(spots, labels, hub, strict=True)):
        if label:
            nodes[n] = -50.0
            nodes[n, label] = 0.0
            continue
        seen = weights.get(shape(text[a:b]))
        if seen is not None:
            nodes[n] = seen
        else:
            nodes[n if h < 0 else h] = prior
    belief = beliefs(nodes, edges, strength)[: len(spots)]
    free = np.array(labels) == 0
    return [
        (int(belief[n].argmax()) - 1, *spots[n])
        for n in np.flatnonzero(free & (belief[:, 1:].max(axis=1) >= ADD)).tolist()
    ]


def all_spans(text: str, weights: dict[str, list[float]]) -> tuple[list, list]:
    """(base spans, all spans), both by kind and start."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, weights))


def unsure(token: str, known: set[str]) -> bool:
    """Whether a token outside the base spans is linked to one inside (``known``: bare), or is a card or email in an odd form."""
    key = bare(token)
    if len(key) >= SHORTEST and key in known:
        return True
    if key.isascii() and key.isdigit():
        return 13 <= len(key) <= 19 and _luhn(key)
    name, at, domain = token.partition("@")
    return bool(name and at and re.fullmatch(r"[^\W_][\w-]*(\.[\w-]+)+", domain))


def learn(docs: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, list[float]]:
    """Log potentials per token shape (``""``: any other shape), from base spans of at most ``rows`` texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int], int] = {}
            for text in texts(batch):
                spots, base = tokens(text), base_spans(text)
                labels = clamped(spots, base)
                known = {bare(text[a:b]) for (a, b), label in zip(spots, labels, strict=True) if label}
                known |= {bare(text[a:b]) for _, a, b in base}
                for (a, b), label in zip(spots, labels, strict=True):
                    if not label and unsure(text[a:b], known):
                        continue
                    key = (shape(text[a:b]), label)
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "shape": pa.array([s for s, _ in counts], pa.string()),
                    "label": pa.array([k for _, k in counts], pa.int32()),
                    "n": pa.array(counts.values(), pa.int64()),
                }
            )

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    chosen = docs.select(key.alias("key")).distinct().orderBy("key").limit(rows)
    sample = docs.select(key.alias("key"), "text").join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("text").alias("text"))
    counted = sample.select("text").mapInArrow(run, "shape string, label int, n long")
    counted = counted.groupBy("shape", "label").agg(F.sum("n").alias("n"))
    # Shapes seen once say no more than unseen ones: few enough remain for every task.
    often = counted.groupBy("shape").agg(F.sum("n").alias("seen")).where("seen > 1").orderBy(F.desc("seen"), "shape").limit(SHAPES)
    table: dict[str, np.ndarray] = {"": np.zeros(1 + len(KINDS))}
    for r in counted.join(F.broadcast(often.select("shape")), "shape").collect():
        for name in (r["shape"], ""):
            table.setdefault(name, np.zeros(1 + len(KINDS)))[r["label"]] += r["n"]
    total = table[""] + 1
    prior = total / total.sum()
    # Smoothed towards the overall shares; softened, so that shape alone never decides.
    return {
        s: (0.5 * np.log(prior if not s else (c + 5 * prior) / (c.sum() + 5))).round(6).tolist()
        for s, c in sorted(table.items())
    }


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Spans of each row: counts of all spans by kind, digest of the base spans, all spans."""
    weights = learn(docs, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in texts(batch):
                base, every = all_spans(text, weights)
                counts.append([sum(k == kind for k, _, _ in every) for kind in range(len(KINDS))])
                digests.append(hashlib.sha256(_text_of(base).encode()).hexdigest())
                spans.append(_text_of(every))
            numbers = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(numbers[:, k]) for k in range(len(KINDS))], pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; a null text stays null; n_chars, if there, counts the new text."""
    weights = learn(docs, rows)
    whole = packed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([mask(text, all_spans(text, weights)[1]) for text in row_texts(batch)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(ROW), new], names=[ROW, "masked"])

    masked = F.when(F.col(f"{ROW}.text").isNotNull(), F.col("masked")).alias("text")
    changed = {"text": masked, "n_chars": F.length(masked).cast("long").alias("n_chars")}
    done = whole.select(ROW).mapInArrow(run, whole.select(ROW, F.col("text").alias("masked")).schema)
    return done.select(*[changed.get(c, F.col(f"{ROW}.`{c}`").alias(c)) for c in docs.columns])


def op8_pii(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
