"""Sets of word shingles and their minwise tokens, for many texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at once, beside a text that is longer by itself.
CHUNK_BYTES = 2 << 20

_U64 = np.uint64
# Odd multipliers of a polynomial over bytes and of the mixing of its values.
_BASE = 0x9E3779B97F4A7C15
_MIX = (_U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB))
_NEXT = _U64(0xD6E8FEB86659FD93)
_ANY_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = (values ^ (values >> _U64(30))) * _MIX[0]
    values = (values ^ (values >> _U64(27))) * _MIX[1]
    return values ^ (values >> _U64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, _U64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts in a row, and the number of words of each text."""
    lowered = [text.lower() for text in texts]
    data = np.frombuffer(b" ".join([*lowered, b""]) + b" ", dtype=np.uint8)
    blank = _BLANK[data]
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([np.zeros(1, _U64), np.cumsum((data.astype(_U64) + _U64(1)) * _powers(_BASE, len(data)))])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(data))
    words = mix((sums[ends] - sums[starts]) * inverse[starts])
    lengths = np.array([len(text) + 1 for text in lowered])
    begins = np.concatenate([[0], np.cumsum(lengths)])
    return words, np.diff(np.searchsorted(starts, begins))


def segments(text: bytes, most: int = CHUNK_BYTES) -> list[bytes]:
    """The text, or parts of about ``most`` bytes that end before a blank."""
    parts, start = [], 0
    while len(text) - start > most:
        blank = _ANY_BLANK.search(text, start + most)
        end = blank.start() if blank else len(text)
        parts.append(text[start:end])
        start = end
    return [*parts, text[start:]] if start < len(text) or not parts else parts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts in a row, and where each text's words begin (one more at the end).

    A word's hash does not depend on its place, so long texts are worked through in segments.
    """
    split = [segments(text) for text in texts]
    parts = [part for own in split for part in own]
    found = [_hashes(parts[some]) for some in chunks(parts)]
    words = np.concatenate([np.empty(0, _U64), *(words for words, _ in found)])
    counts = np.concatenate([np.zeros(1, np.int64), *(counts for _, counts in found)])
    return words, np.cumsum(counts)[np.cumsum([0, *map(len, split)])]


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of ``size`` words; a shorter text is one run."""
    words, bounds = word_hashes(texts)
    runs = words.copy()
    for step in range(1, size):
        later = np.zeros_like(words)
        later[: len(words) - step] = words[step:]
        runs = mix(runs * _NEXT + later)
    sets = []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin >= size:
            sets.append(np.unique(runs[begin : end - size + 1]))
        elif end > begin:
            # The length takes part, so that a short text equals only one of the same words.
            one = mix(words[begin : begin + 1] + _U64(end - begin))
            for word in words[begin + 1 : end]:
                one = mix(one * _NEXT + word)
            sets.append(one)
        else:
            sets.append(np.empty(0, _U64))
    return sets


def multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * _U64(2) + _U64(1)


def tokens(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Minwise tokens of nonempty sets, one row per set and one column per factor."""
    flat = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(factors)), dtype=np.uint32)
    for column, factor in enumerate(factors):
        least = np.minimum.reduceat(flat * factor, begins)
        out[:, column] = (mix(least) >> _U64(32)).astype(np.uint32)
    return out


def chunks(texts: list[bytes | None], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Runs of texts that hold ``most`` bytes, or one longer text."""
    start = held = 0
    for place, text in enumerate(texts):
        length = len(text or b"")
        if held and held + length > most:
            yield slice(start, place)
            start, held = place, 0
        held += length
    if start < len(texts):
        yield slice(start, len(texts))
