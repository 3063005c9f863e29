"""Texts cut where no token of a byte-level BPE can cross, so that equal parts are encoded once.

Such a tokenizer first splits a text by a pattern in which white space follows
no other character within a part.  A border between a character that is surely
not white and one that surely is therefore ends a part, whatever stands around
it: the ids of a text are those of its units in a row.  Characters whose class
depends on the version of Unicode never begin or end a unit.  A text without
white space is one unit.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np

# Surely white to every tokenizer here, and perhaps white (U+2581 is a blank to SentencePiece) or part of a token
# with what stands before.
SURE = r" \n"
DOUBTFUL = r"\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2581\u3000\ufeff"
UNIT = re.compile(f"[{SURE}]*(?:[^{SURE}{DOUBTFUL}]+|[{DOUBTFUL}][{SURE}]*)+|[{SURE}]+")
# The same where nothing is doubtful.
PLAIN_UNIT = re.compile(f"[{SURE}]*[^{SURE}]+|[{SURE}]+")
ANY_DOUBTFUL = re.compile(f"[{DOUBTFUL}]")
BORDER = re.compile(f"(?<=[^{SURE}{DOUBTFUL}])[{SURE}]")
# A unit between two borders, whatever stands around it.
BETWEEN = re.compile(f"[{SURE}].*[^{SURE}{DOUBTFUL}]", re.DOTALL)
# Letters (Latin, Greek, Cyrillic), digits and signs in every version of Unicode; letters behind an apostrophe may be
# of its token.
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0391-\u03a1\u03a3-\u03c9\u0400-\u045f"
DIGITS = "0-9"
SIGNS = r"!-&(-/:-@\[-`{-~"
# A unit of these alone, and the parts in which a byte-level tokenizer splits a row of such units.
CLASSED = re.compile(f"[{SURE}][{LETTERS}{DIGITS}{SIGNS}]+")
PART = re.compile(f"\n| ?(?:[{LETTERS}]+|[{DIGITS}]+|[{SIGNS}]+)")

#: Characters that are cut into units at once.
SLICE = 1 << 20
#: Units of a generation that a worker remembers, and the longest of them.
KEPT = 400_000
LONGEST_KEPT = 64


def fits(tokenizer: dict) -> bool:
    """Whether a tokenizer (its JSON) splits as the module says: byte level, no normaliser, plain special tokens."""
    split = tokenizer.get("pre_tokenizer") or {}
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    special = all(
        not (token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(f"[{SURE}{DOUBTFUL}]", token["content"]))
        for token in tokenizer.get("added_tokens", ())
    )
    return byte_level and special and not tokenizer.get("normalizer") and not tokenizer.get("truncation")


def slices(text: str, cut: bool = True) -> Iterator[list[str]]:
    """Units of the whole text, in runs of ``SLICE`` characters or one longer unit."""
    if not cut:
        yield [text] if text else []
        return
    start, length = 0, len(text)
    while start < length:
        border = BORDER.search(text, start + SLICE) if start + SLICE < length else None
        end = border.start() if border else length
        pattern = UNIT if ANY_DOUBTFUL.search(text, start, end) else PLAIN_UNIT
        yield pattern.findall(text, start, end)
        start = end


def runs(texts: Iterable[str], most: int = SLICE >> 1) -> Iterator[list[str]]:
    """Texts in their order, together as many as have ``most`` characters, or one longer text."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def joined(values: list[bytes], rows: Iterable[list[str]]) -> list[bytes]:
    """Values of all units of some rows, put together by row."""
    following = iter(values)
    return [b"".join(islice(following, len(row))) for row in rows]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Fixed rule: printable Latin-1 characters stand for themselves, the other
    bytes for the characters from 256 on, in their order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


BYTE_LEVEL = {byte: character for character, byte in byte_alphabet().items()}


def byte_level(tokenizer_json: str, plain_special: bool = False):
    """The tokenizer, and whether its texts may be cut into units."""
    # One worker runs beside others of its executor, so the library starts no threads of its own.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = plain_special
    return tokenizer, fits(json.loads(tokenizer_json))


class ByteLevel:
    """A byte-level tokenizer that encodes many units at once.

    Units that begin and end at borders, whatever stands around them, are one
    text when they are written in a row, and the lengths of its tokens tell
    which unit each of them is of.  Where it is sure how a row is split, the
    model gets its parts as they are.
    """

    def __init__(self, tokenizer_json: str, plain_special: bool = False) -> None:
        self.tokenizer, self.cut = byte_level(tokenizer_json, plain_special)
        vocabulary, added = self.tokenizer.get_vocab(with_added_tokens=False), self.tokenizer.get_added_tokens_decoder()
        self.lengths = np.zeros(max([*vocabulary.values(), *added], default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        for i, token in added.items():
            self.lengths[i] = len(token.content.encode())
        #: Texts that are a token wherever they stand.
        self.special = [] if plain_special else [token.content for token in added.values()]
        # Without a token for every byte some would be left out.
        self.joins = self.cut and sum(len(token) == 1 for token in vocabulary) >= 256

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _classed(self, new: list[str]) -> list[str]:
        classed = [*filter(CLASSED.fullmatch, new)]
        text = "".join(classed)
        special = [token for token in self.special if token in text]
        return [unit for unit in classed if not any(token in unit for token in special)] if special else classed

    def _row_ids(self, classed: list[str]) -> Iterator[int]:
        tokenize = self.tokenizer.model.tokenize
        parts = "\t".join(PART.findall("".join(classed))).encode().decode("latin-1").translate(BYTE_LEVEL)
        return (token.id for part in parts.split(BYTE_LEVEL[9]) for token in tokenize(part))

    def encode(self, new: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The units in another order, their ids in that order, and where the ids of each of them stop."""
        classed = self._classed(new) if self.joins else []
        rest = [*set(new).difference(classed)]
        row = [*filter(BETWEEN.fullmatch, rest)] if self.joins else []
        if len(classed) + len(row) > 1:
            others = [*set(rest).difference(row)]
            order = classed + row + others
            found = self._ids(["".join(row), *others])
            ids = np.fromiter(chain(self._row_ids(classed), *found), np.int64)
            ends, borders = np.cumsum(self.lengths[ids]), np.cumsum([len(unit.encode()) for unit in order])
            last = np.searchsorted(ends, borders)
            if ends[-1] == borders[-1] and np.array_equal(ends[last], borders):
                return order, ids, last + 1
        found = self._ids(new)
        return new, np.fromiter(chain.from_iterable(found), np.int64), np.cumsum([*map(len, found)])


class Memory:
    """What was found out about units, in two generations: the older one makes room, but for units that came again."""

    def __init__(self, kept: int = KEPT) -> None:
        self.kept = kept
        self.known: dict = {}
        self.older: dict = {}

    def missing(self, found: list[str]) -> list[str]:
        """Units of ``found`` that are not in :attr:`known` yet."""
        if len(self.known) > self.kept:
            self.known, self.older = {}, self.known
        new = set(found).difference(self.known)
        if new and self.older:
            again = [unit for unit in new if unit in self.older]
            self.known.update((unit, self.older[unit]) for unit in again)
            new.difference_update(again)
        return list(new)

    def values(self, found: list[str], learn: Callable[[list[str]], Iterable[tuple]]) -> list:
        """What is known of each of the units; ``learn`` gives new ones, in any order, with what is to be known."""
        values = [*map(self.known.get, found)]
        holes = [place for place, value in enumerate(values) if value is None]
        if holes:
            new = self.missing([found[place] for place in holes])
            if new:
                self.known.update(learn(new))
            for place in holes:
                values[place] = self.known[found[place]]
            self.drop_long(new)
        return values

    def drop_long(self, units: list[str]) -> None:
        for unit in units:
            if len(unit) > LONGEST_KEPT:
                del self.known[unit]
