"""Deep-shallow sorting of equally long strings.

A multikey quicksort orders strings by their first words of eight bytes, all
groups of a level at once; groups that are still equal at the shallow depth are
ordered by blind tries, which keep one branching position per node and compare
a new string with a single leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD_BYTES = 8
#: Words up to which the quicksort goes before tries take over.
SHALLOW_WORDS = 3


def as_words(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The strings ``data[start:start + length]`` as rows of big-endian words, padded with zeros."""
    count = -(-length // WORD_BYTES)
    rows = np.zeros((len(starts), count * WORD_BYTES), dtype=np.uint8)
    for begin in range(0, len(starts), 1 << 14):  # an index takes eight times the room of what it fetches
        some = starts[begin : begin + (1 << 14), None]
        rows[begin : begin + (1 << 14), :length] = data[some + np.arange(length)]
    return rows.view(">u8").astype(np.uint64)


def _bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def partition_by_word(values: np.ndarray, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Order rows within ``groups`` by ``values``; returns the finer groups.

    Each round takes a pivot per group, the middle one of three of its values,
    and splits the group into smaller, equal and larger; equal parts are done.
    ``order`` is rearranged in place, ``groups`` are numbers that do not decrease.
    """
    groups = groups * 3
    active = np.arange(len(order))
    while True:
        bounds = _bounds(groups[active])
        sizes = np.diff(bounds)
        active = active[np.repeat(sizes > 1, sizes)]
        if not len(active):
            break
        keys, rows = groups[active], order[active]
        bounds = _bounds(keys)
        first, last = bounds[:-1], bounds[1:] - 1
        own = values[rows]
        number = np.repeat(np.arange(len(first)), np.diff(bounds))
        pivot = np.sort(np.stack([own[first], own[(first + last) // 2], own[last]]), axis=0)[1]
        against = pivot[number]
        side = (own > against).astype(np.int64) - (own < against)
        local = number * 3 + side + 1
        moved = np.argsort(local, kind="stable")
        order[active] = rows[moved]
        sorted_local = local[moved]
        # New numbers keep the order of all groups: a group's parts lie between its neighbours'.
        fresh = np.concatenate([[True], np.diff(sorted_local) != 0])
        changed = np.zeros(len(order), dtype=bool)
        changed[1:] = groups[1:] != groups[:-1]
        changed[active[fresh]] = True
        groups = np.cumsum(changed)
        active = active[sorted_local % 3 != 1]
        if not len(active):
            break
    return _renumbered(groups)


def _renumbered(groups: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(groups[1:] != groups[:-1])])


class BlindTrie:
    """Strings given as whole numbers of ``length`` bytes."""

    def __init__(self, length: int):
        self.length = length
        self.root: tuple | list | None = None

    def byte(self, value: int, place: int) -> int:
        return value >> 8 * (self.length - 1 - place) & 255

    def add(self, value: int, row: int) -> None:
        if self.root is None:
            self.root = [value, row]
            return
        node = self.root
        while isinstance(node, tuple):  # down without comparing what the nodes skip
            place, kids = node
            node = kids.get(self.byte(value, place)) or next(iter(kids.values()))
        difference = node[0] ^ value
        if not difference:
            node.append(row)
            return
        place = self.length - (difference.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < place:
            above, node = node, node[1][self.byte(value, node[0])]
        leaf = [value, row]
        if isinstance(node, tuple) and node[0] == place:
            node[1][self.byte(value, place)] = leaf
            return
        some = node
        while isinstance(some, tuple):
            some = next(iter(some[1].values()))
        split = (place, {self.byte(some[0], place): node, self.byte(value, place): leaf})
        if above is None:
            self.root = split
        else:
            above[1][self.byte(value, above[0])] = split

    def leaves(self) -> Iterator[list[int]]:
        """Rows of equal strings, in the order of the strings."""
        todo = [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo.extend(node[1][key] for key in sorted(node[1], reverse=True))
            else:
                yield node[1:]


def sort(words: np.ndarray, groups: np.ndarray, shallow: int = SHALLOW_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``words`` sorted within ``groups``, and for each place of the result the number of its class.

    Rows are of one class if they are of one group and equal.
    """
    order = np.argsort(groups, kind="stable")
    classes = _renumbered(groups[order]) if len(order) else np.zeros(0, dtype=np.int64)
    for word in range(min(shallow, words.shape[1])):
        classes = partition_by_word(words[:, word], order, classes)
    deep = words.shape[1] - shallow
    if deep <= 0 or not len(order):
        return order, classes
    bounds = _bounds(classes)
    sizes = np.diff(bounds)
    fresh = np.zeros(len(order), dtype=bool)
    fresh[bounds[:-1]] = True
    # A trie of two strings is one comparison.
    two = bounds[:-1][sizes == 2]
    a, b = words[order[two], shallow:], words[order[two + 1], shallow:]
    unlike = a != b
    place = unlike.argmax(axis=1)
    differ = unlike.any(axis=1)
    swap = two[differ & (a[np.arange(len(two)), place] > b[np.arange(len(two)), place])]
    order[swap], order[swap + 1] = order[swap + 1], order[swap].copy()
    fresh[two[differ] + 1] = True
    tail = np.ascontiguousarray(words[:, shallow:].astype(">u8"))
    for begin, end in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
        trie = BlindTrie(deep * WORD_BYTES)
        rows = order[begin:end]
        for row in rows.tolist():
            trie.add(int.from_bytes(tail[row].tobytes(), "big"), row)
        at = begin
        for equal in trie.leaves():
            fresh[at] = True
            order[at : at + len(equal)] = equal
            at += len(equal)
    return order, np.cumsum(fresh) - 1
