"""URL filters by a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL (host + path).  All globs are packed into the words of
one Shift-And automaton: a state bit per glob position, shifts carried from word to word, one pass
over the bytes of a URL moves every glob at once, and a whole batch of URLs moves together.

Host and path rules become two globs each: ``host/path*`` and ``*.host/path*``; of the rules that
fit, the longest wins.  Where none fits, the method's own globs decide: any hit blocks, else allow.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and
is allowed; rows are judged one by one, so repeated rows, null ids, other columns and empty tables
need nothing special; a URL may hold any signs, line breaks too; a very long URL costs its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the filter.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
BORDER = b"\xff"  # a byte that no text in UTF-8 holds
BLOCK_GLOBS = ("*casino*", "*cheap-pills*", "*spam-farm*")


class GlobSet:
    """Globs (``*`` any bytes, ``?`` one byte) matched against whole strings, all at once."""

    def __init__(self, globs: Sequence[str | bytes]):
        units: list[list[tuple[int | None, bool]]] = []  # per glob: (byte or any, stays on any byte afterwards)
        self.starts_loose = []
        for glob in globs:
            loose, cells = False, []
            for byte in glob.encode() if isinstance(glob, str) else glob:
                if byte == ord("*"):
                    if cells:
                        cells[-1] = (cells[-1][0], True)
                    else:
                        loose = True
                else:
                    cells.append((None if byte == ord("?") else byte, False))
            units.append(cells)
            self.starts_loose.append(loose)
        bits = sum(len(cells) + 1 for cells in units)
        self.words = -(-bits // 64)
        self.accept: list[tuple[int, np.uint64]] = []
        masks = np.zeros((256, self.words), np.uint64)
        self.first, self.stay = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        at = 0
        # The leading bit of a glob stands for "nothing read yet".
        for cells, loose in zip(units, self.starts_loose, strict=True):
            self._set(self.first, at)
            if loose:
                self._set(self.stay, at)
            for byte, stays in cells:
                at += 1
                for code in range(256) if byte is None else (byte,):
                    self._set(masks[code], at)
                if stays:
                    self._set(self.stay, at)
            self.accept.append((at // 64, np.uint64(1) << np.uint64(at % 64)))
            at += 1
        self.masks = masks

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def match(self, strings: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: string by glob."""
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(strings), np.uint8)
        begin = (ends - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.first, (len(strings), 1))
        one, top = np.uint64(1), np.uint64(63)
        live = len(strings)
        for k in range(int(lengths[0]) if len(lengths) else 0):
            while live and lengths[live - 1] <= k:
                live -= 1
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= self.masks[data[begin[:live] + k]]
            now &= self.stay
            now |= moved
        hits = np.empty((len(strings), len(self.accept)), bool)
        for glob, (word, bit) in enumerate(self.accept):
            hits[order, glob] = state[:, word] & bit != 0
        return hits


def canonical(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) of a URL; both empty without ``://``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(LOWER), slash + path


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, block: Sequence[str] = BLOCK_GLOBS, rows: int = 2048
) -> DataFrame:
    """page_id, host, path, the longest rule that fits, and the verdict of every page."""
    ranked = sorted(rules, key=lambda rule: -len(rule.text))
    globs = [prefix + _plain(rule) + b"*" for rule in ranked for prefix in (b"", b"*.")]
    names = pa.array([rule.text for rule in ranked], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobSet([*globs, *block])
        verdicts = np.array([rule.verdict for rule in ranked] + ["block", "allow"])
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                parts = [canonical(value.as_py()) for value in batch.column("url")]
                # The border of host and path is marked, so that a rule's host cannot match inside a path.
                hits = automaton.match([BORDER.join((host.encode(), path.encode())) for host, path in parts])
                fits = hits[:, : len(globs)].reshape(len(parts), -1, 2).any(axis=2)
                found = fits.any(axis=1)
                best = np.where(found, fits.argmax(axis=1) if fits.shape[1] else 0, len(ranked) + 1)
                best[~found & hits[:, len(globs) :].any(axis=1)] = len(ranked)
                index = pa.array(np.where(found, best, 0), mask=~found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"),
                        pa.array([host for host, _ in parts], pa.string()),
                        pa.array([path for _, path in parts], pa.string()),
                        names.take(index),
                        pa.array(verdicts[best].tolist(), pa.string()),
                    ],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, SCHEMA)


def _plain(rule: Rule) -> bytes:
    if set("*?") & set(rule.text):
        raise ValueError(f"a rule is no glob: {rule.text}")
    return BORDER.join((rule.host.encode(), rule.path.encode()))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP2_SQL = r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) as path
  from parts
), ruled as (
  select *, case
    when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
    when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
    when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
    when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
    when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/' end as rule
  from split
)
select page_id, host, path, rule, case
    when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when contains(host || path, 'casino') or contains(host || path, 'cheap-pills') or contains(host || path, 'spam-farm')
      then 'block' else 'allow' end as verdict
from ruled
"""
