"""Spelling variant grouping by a variable-length gram index.

Words are counted over all texts, combined in each task before the shuffle.  The dictionary holds the grams of
the padded words that occur in more than FREQUENT words (frequency-pruned, at most DICTIONARY of them): at each place of a
word the gram is lengthened while it is in the dictionary, up to LONGEST letters, and grams that lie inside an earlier one are dropped.
For every word the index knows the most grams that one edit can affect (``affected``): those that hold the edited letter, those
before it that could grow into it, and those after it that a new gram could cover.  Pads of LONGEST - 1 signs on both
sides leave at least one gram unaffected by any edit, so two near words always share one.

Of a word with bound k only the lists of its k + 1 rarest grams are merged: two near words share the rarest of their
unaffected grams, and it is among these in both.  Lists are kept by gram, place and length, for words of equal
length and for words that differ by one letter (where the place may move by one).  Words that meet must pass the
count filter (grams of one that the other lacks are no more than its bound, as bits) and are then verified to be
exactly one edit apart.  Lists are joined by Spark, never collected.

Forms point to a word at least twice as frequent, so chains are short; roots are found by doubling steps.

Defined results: a null text has no words; a null doc_id reads as empty text before the colon; repeated rows count again;
ties as the contract says; a run whose only code point is deleted is no word; an empty table gives no rows; other
columns of any name are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, texts

# Runs of letters A-Z, a-z and U+00C0 to U+00FF in UTF-8, one deletion in 97 runs, words of five letters, three times.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
DAMAGED = 97
MIN_LETTERS, MIN_SEEN = 5, 3

SHORTEST, LONGEST = 2, 4
PAD = LONGEST - 1
FREQUENT = 500
DICTIONARY = 50_000
# Grams whose number is known to every task, for the order of the lists; the others count as rare.
KNOWN_FROM, KNOWN = 50, 100_000
FLUSH = 200_000


# --- words ------------------------------------------------------------------------------


def runs_of(doc_id: int | None, text: str) -> list[bytes]:
    """The lower-cased runs of a text, with a letter deleted from those that the fixed rule names."""
    runs = RUN.findall(text.encode().translate(LOWER))
    crc = zlib.crc32
    start = crc(f"{'' if doc_id is None else doc_id}:".encode())
    for n, h in enumerate([crc(run, start) for run in runs]):
        if not h % DAMAGED:
            word = runs[n].decode()
            place = h % len(word)
            runs[n] = (word[:place] + word[place + 1 :]).encode()
    return runs


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                seen.update(runs_of(doc_id, text))
                if len(seen) > FLUSH:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_SEEN)


def _counted(seen: Counter) -> pa.RecordBatch:
    kept = [(w.decode(), n) for w, n in seen.items() if len(w) >= MIN_LETTERS]
    # a letter may have two bytes
    kept = [(w, n) for w, n in kept if len(w) >= MIN_LETTERS]
    return pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
    )


# --- grams ------------------------------------------------------------------------------


def padded(word: str) -> str:
    return "^" * PAD + word + "$" * PAD


class Grams:
    """The dictionary: which grams are lengthened, and how frequent grams are."""

    def __init__(self, known: dict[str, int], frequent: int = FREQUENT):
        self.known = known
        self.longer = {g for g, n in known.items() if n > frequent and len(g) < LONGEST}
        # What a gram of the dictionary can end with after its first letter, but for the last letter.
        self.tails = {g[k:] for g in self.longer for k in range(1, len(g))}

    def of(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the variable grams of a padded word."""
        found, last, size = [], 0, len(text)
        for start in range(size - SHORTEST + 1):
            end = start + SHORTEST
            while end < size and text[start:end] in self.longer:
                end += 1
            if end > last:
                found.append((start, end))
                last = end
        return found

    def affected(self, text: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of a padded word that one inserted, deleted or replaced letter can change."""
        most, low = 0, 0
        for place in range(PAD, len(text) - PAD + 1):
            # Grams further left end before the letter and cannot grow into it.
            while grams[low][1] < place:
                low += 1
            inside, between = 0, 0
            for start, end in grams[low:]:
                if start > place + LONGEST:
                    break
                grows = end == place and text[start:end] in self.longer
                if end <= place:
                    inside += grows
                    between += grows
                    continue
                # The letter at ``place`` itself, and the gap before it.
                inside += start <= place or (end - place <= LONGEST and text[place + 1 : end - 1] in self.tails)
                between += start < place or (end - place < LONGEST and text[place : end - 1] in self.tails)
            most = max(most, between, inside if place < len(text) - PAD else 0)
        return most

    def lists(self, text: str, grams: list[tuple[int, int]], bound: int) -> list[tuple[str, int]]:
        """(gram, place) of the lists to merge: the rarest bound + 1."""
        order = sorted((self.known.get(text[a:b], 0), text[a:b], a) for a, b in grams)
        return [(gram, a) for _, gram, a in order[: bound + 1]]


def known_grams(vocabulary: DataFrame, least: int = KNOWN_FROM, limit: int = KNOWN) -> dict[str, int]:
    """How many places of the vocabulary hold each frequent gram; at most ``limit`` of them, the most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                text = padded(word)
                for size in range(SHORTEST, LONGEST + 1):
                    seen.update([text[p : p + size] for p in range(len(text) - size + 1)])
                if len(seen) > FLUSH:
                    yield _numbered(seen)
                    seen = Counter()
        yield _numbered(seen)

    counted = vocabulary.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # A gram stands in at least as many places as any longer one that begins with it: prefixes come first.
    often = counted.where(F.col("n") >= least).orderBy(F.desc("n"), F.length("gram"), "gram").limit(limit)
    return {r["gram"]: r["n"] for r in often.collect()}


def _numbered(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["gram", "n"]
    )


def _bits(parts: Iterable[str]) -> int:
    """One bit of 64 for each part, as a signed number."""
    bits = 0
    for part in parts:
        bits |= 1 << (zlib.crc32(part.encode()) >> 26)
    return bits - ((bits >> 63) << 64)


INDEX = "word string, n long, letters int, bound int, grams long, chars long, lists array<struct<gram string, place int>>"


def gram_index(vocabulary: DataFrame, known: dict[str, int], frequent: int = FREQUENT) -> DataFrame:
    """One row per word: its bound, its grams and letters as bits, the lists to merge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Grams(known, frequent)
        kind = pa.list_(pa.struct([("gram", pa.string()), ("place", pa.int32())]))
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                text = padded(word)
                grams = table.of(text)
                bound = table.affected(text, grams)
                lists = [{"gram": g, "place": p} for g, p in table.lists(text, grams, bound)]
                rows.append((word, n, len(word), bound, _bits(text[a:b] for a, b in grams), _bits(word), lists))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), kind]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["word", "n", "letters", "bound", "grams", "chars", "lists"],
            )

    return vocabulary.select("word", "n").mapInArrow(run, INDEX)


# --- near words -------------------------------------------------------------------------


def near_words(index: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all words that are one edit apart, both ways round."""
    posted = index.withColumn("l", F.explode("lists"))
    gram, place, letters = F.col("l.gram"), F.col("l.place"), F.col("letters")
    equal = F.xxhash64(F.lit(0), letters, gram, place)
    shorter = F.xxhash64(F.lit(1), letters, gram, place)
    longer = [F.xxhash64(F.lit(1), letters - 1, gram, place - move) for move in (0, 1)]
    facts = ("word", "n", "bound", "grams", "chars")

    def side(name: str, keys: list) -> DataFrame:
        # A list holds a word once, whatever way it came.
        return posted.select(F.explode(F.array_distinct(F.array(*keys))).alias("key"), *facts).select(
            "key", *[F.col(c).alias(f"{name}_{c}") for c in facts]
        )

    left, right = side("a", [equal, shorter]), side("b", [equal, *longer])
    lacks = lambda x, y: F.bit_count(F.col(f"{x}_grams").bitwiseAND(F.bitwise_not(f"{y}_grams")))
    meet = (
        # one replaced letter changes two signs at most
        (F.bit_count(F.col("a_chars").bitwiseXOR(F.col("b_chars"))) <= 2)
        & (lacks("a", "b") <= F.col("a_bound"))
        & (lacks("b", "a") <= F.col("b_bound"))
        & ((F.length("a_word") < F.length("b_word")) | (F.col("a_word") < F.col("b_word")))
        & (F.levenshtein("a_word", "b_word", 1) == 1)
    )
    pairs = left.join(right, "key").where(meet).select("a_word", "a_n", "b_word", "b_n").distinct()
    ways = F.array(
        *[
            F.struct(
                F.col(f"{x}_word").alias("word"), F.col(f"{x}_n").alias("n"),
                F.col(f"{y}_word").alias("near"), F.col(f"{y}_n").alias("near_n"),
            )
            for x, y in ("ab", "ba")
        ]
    )
    return pairs.select(F.explode(ways).alias("w")).select("w.*")


def forms(near: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of each word that has near words; form is null where none is frequent enough."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    grouped = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    enough = form_n >= 2 * F.col("n")
    return grouped.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, form_n).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of each word that has a form: the last form of its chain.

    Each step doubles the part of the chain that is known; forms at least double the count, so a chain has at most
    62 links and six steps are enough.
    """
    known = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    for _ in range(7):
        after = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = known.join(after, "root", "left")
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = stored(moved, "roots")
        known = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            break
    return known


def variants(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    vocabulary = stored(words(docs), "words")
    index = stored(gram_index(vocabulary, known_grams(vocabulary), frequent), "gram_index")
    found = stored(forms(near_words(index)), "forms")
    return (
        vocabulary.join(found, "word", "left")
        .join(roots(found), "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
with recursive crc_table as (
  select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as t from range(256) r(n)
), runs as (
  select coalesce(cast(doc_id as varchar), '') as doc,
         unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as raw from documents where text is not null
), lowered as (
  select doc, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs group by all
), hashed as (
  -- code points up to U+00FF: one byte or two
  select run, n, xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(doc || ':' || run, ''),
      lambda c: case when ord(c) < 128 then [cast(ord(c) as bigint)] when ord(c) < 192 then [194, cast(ord(c) as bigint)]
                     else [195, cast(ord(c) as bigint) - 64] end))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) as h
  from lowered, crc_table
), changed as (
  select case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed
), words as (
  select word, cast(sum(n) as bigint) as n from changed where length(word) >= 5 group by word having sum(n) >= 3
), shorter as (
  select word, n, i, left(word, i) || substr(word, i + 2) as rest
  from (select word, n, unnest(range(length(word))) as i from words)
), near as (
  select distinct a.word, a.n, b.word as other, b.n as other_n from shorter a join shorter b using (i, rest) where a.word <> b.word
  union select s.word, s.n, w.word, w.n from shorter s join words w on s.rest = w.word
  union select w.word, w.n, s.word, s.n from shorter s join words w on s.rest = w.word
), best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n, any_value(n) as n
  from near group by word
), forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * w.n then other end as form,
         case when other_n >= 2 * w.n then other_n end as form_n
  from words w left join best b on w.word = b.word
), chain as (
  select word, word as last, 0 as step from forms
  union all select c.word, f.form, step + 1 from chain c join forms f on c.last = f.word where f.form is not null
)
select f.word, form, root, n, n_near, form_n
from forms f join (select word, arg_max(last, step) as root from chain group by word) r on f.word = r.word
"""
