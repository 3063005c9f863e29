"""Runs of words against a search of every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpora import documents, odd_rows

from forgelens.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_row(doc_id, text, tail=True):
    words = WORD.findall(text or "")
    n = len(words)
    if tail and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = best[0] is not None and 1000 * best[1] // best[2]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli if runs else None, sha(lines), sha(kept))


def key(row):
    return tuple((value is None, value) for value in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def random_words(rng: random.Random) -> list[str]:
    letters = "ab" if rng.random() < 0.5 else "abcdefg"
    words: list[str] = []
    while len(words) < rng.randrange(1, 120):
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
        words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 70)]
    return words


def found_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """The steps of the operator without Spark."""
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes = periodic_runs.word_hashes(raw, *periodic_runs.word_edges(raw))
    parts = []
    for size, found in periodic_runs.boundaries(hashes):
        for lo, hi, first, last in periodic_runs.blocks(len(hashes), size, found):
            parts += periodic_runs.solve(hashes[lo:hi].tolist(), lo, first, last, size, len(hashes))
    parts.sort()
    joined: list[list[int]] = []
    for p, start, end in parts:
        if joined and joined[-1][0] == p and start + p <= joined[-1][2]:
            joined[-1][2] = max(end, joined[-1][2])
        else:
            joined.append([p, start, end])
    least: dict = {}
    for p, start, end in joined:
        if end - start >= max(6, 4 * p):
            least[start, end - start] = min(p, least.get((start, end - start), p))
    return sorted((*where, p) for where, p in least.items())


@pytest.mark.parametrize("block", [1 << 16, 1])
def test_tiles_find_all_runs(block, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(1500):
        words = random_words(rng)
        assert found_runs(words) == plain_runs(words), words


def test_long_texts_of_one_word_and_of_long_periods():
    words = ["x"] * 3000
    assert found_runs(words) == [(0, 3000, 1)]
    unit = [f"w{i}" for i in range(700)]
    words = ["a", "b", *unit * 5, *unit[:333], "c"]
    assert found_runs(words) == [(2, 3833, 700)]


def test_words_are_split_at_the_six_blanks_over_slices(monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE", 3)
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("ab \t\n\v\f\r\x1c\x85é") for _ in range(rng.randrange(20)))
        raw = np.frombuffer(text.encode(), np.uint8)
        starts, ends = periodic_runs.word_edges(raw)
        words = WORD.findall(text)
        assert [bytes(raw[s:e]).decode() for s, e in zip(starts, ends)] == words
        hashes = periodic_runs.word_hashes(raw, starts, ends).tolist()
        assert len(set(hashes)) == len(set(words)) and len(hashes) == len(words)


def test_long_words_are_told_apart():
    words = ["a" * 60 + "b", "a" * 60 + "c", "a" * 61, "a" * 60 + "b"]
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes = periodic_runs.word_hashes(raw, *periodic_runs.word_edges(raw)).tolist()
    assert hashes[0] == hashes[3] and len(set(hashes)) == 3


def op11(frame, tail=queries.repeated_tail):
    return periodic_runs.digests(periodic_runs.runs(frame, tail)).collect()


def test_rows_equal_a_search_of_all_periods(spark):
    rng = random.Random(7)
    rows = [(i % 150, " ".join(random_words(rng)), "en", "a") for i in range(300)]
    same(op11(documents(spark, rows).repartition(5)), [plain_row(i, t) for i, t, _, _ in rows])


def test_small_blocks_are_stitched_over_tasks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(["z", *[rng.choice("abc") for _ in range(rng.randrange(1, 9))] * 60, "y"])) for i in range(20)]
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows])
    tiled = periodic_runs.tiles(frame)
    fragments = periodic_runs.fragments(tiled)
    assert fragments.count() >= 20
    same(op11(frame, None), [plain_row(i, t, tail=False) for i, t in rows])


def test_odd_rows_and_extra_columns(spark, odd):
    # Searching all periods of the long text takes too long; it has no run but what its tail makes.
    short = [row for row in odd_rows() if len(row[1] or "") < 10_000]
    got = [row for row in op11(odd) if row.doc_id != 5]
    same(got, [plain_row(i, t) for i, t, _, _ in short])
    assert len(op11(odd)) == len(odd_rows())


def test_empty_table_has_no_runs(spark, empty):
    assert op11(empty) == []


def test_query_over_the_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: tuple(row) for row in queries.queries()["op11_periodic_runs"](spark, path).collect()}
    assert len(got) == len(rows)
    short = [row for row in rows if len(row.text or "") < 20_000]
    assert {row.doc_id: got[row.doc_id] for row in short} == {row.doc_id: plain_row(*row) for row in short}
