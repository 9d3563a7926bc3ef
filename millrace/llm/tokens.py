"""Byte-level BPE inside a task: pre-tokens are encoded once and remembered."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import pack

import numpy as np

# The pre-token pattern, its classes written out below U+0250.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \x85\xa0"
PRE_TOKEN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    f"| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WIDE = re.compile("[^\x00-ɏ]")
# A space that no letter, number or sign follows; elsewhere a pre-token starts at every space.
LOOSE = re.compile(f" (?![^{SPACES}])")

# Words longer than this are neither remembered nor given to the fast encoder.
LONG_WORD = 400


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in the vocabulary file: printable ones for themselves, the others shifted past 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder(dict):
    """Word -> its ids as little-endian unsigned 32-bit integers.

    A word is one or more whole pre-tokens.  ``limit`` bounds the remembered words: when full, the
    first and so mostly frequent ones stay, until many have been missed.
    """

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self.limit, self.missed = limit, 0
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        alphabet = byte_alphabet()
        self.added = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        ranks = {
            bytes(alphabet[c] for c in token): rank
            for token, rank in vocabulary["model"]["vocab"].items()
            if token not in self.added
        }
        size = max([*ranks.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        for token, rank in self.added.items():
            self.bytes_of[rank] = token.encode()
        # The ids of this vocabulary are its merge order, so they serve as ranks.
        self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = re.compile("(" + "|".join(re.escape(t) for t in self.added) + ")") if self.added else None

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONG_WORD or WIDE.search(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(word)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONG_WORD:
            if len(self) < self.limit:
                self[word] = packed
            else:
                self.missed += 1
                if self.missed > 8 * self.limit:
                    self.missed = 0
                    self.clear()
        return packed

    def words(self, text: str) -> list[str]:
        """A text without added tokens, cut between pre-tokens: at spaces if each starts a pre-token, else at all."""
        if not text.isascii() and WIDE.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        if "\0" in text or LOOSE.search(text):
            return PRE_TOKEN.findall(text)
        words = text.replace(" ", "\0 ").split("\0")
        return words if words[0] else words[1:]

    def segments(self, text: str) -> list[str]:
        """The text cut at added tokens, which stand at the odd places."""
        return self.split.split(text) if self.split else [text]

    def added_id(self, token: str) -> bytes:
        return np.array([self.added[token]], "<u4").tobytes()

    def encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, cut where a letter is followed by a space and so a pre-token ends in any case."""
        out = []
        for place, part in enumerate(self.segments(text)):
            if place % 2:
                out.append(self.added_id(part))
                continue
            start = 0
            while len(part) - start > 1 << 20:
                cut = SAFE.search(part, start + (1 << 20) - 1)
                if not cut:
                    break
                out.append(self.encode_plain(part[start : cut.start() + 1]))
                start = cut.start() + 1
            out.append(self.encode_plain(part[start:] if start else part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


SAFE = re.compile("[a-z](?= [a-z])")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, kept between tasks."""
    return Encoder(path)
