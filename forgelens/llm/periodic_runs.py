"""Runs of repeated words: maximal stretches of a period that holds four times or more.

A stretch of words has period q if words q apart are equal.  Periods are taken
by octaves, S to 2S - 1 with S a power of two, and an octave cuts a document
into tiles: one for every boundary c, a multiple of S, from S words before it
to 4S words behind.  A run of period p has at least two boundaries with
``c + p + S`` inside it, and the tiles of all of these together cover it and its
neighbours.

1. In the document's task, hashes of windows of S words show at which boundaries
   the window comes again at one distance of the octave, here and at the next
   boundary.  Only these tiles are kept, neighbouring ones as one block of
   ``BLOCK`` words or one larger tile, so a long document becomes many rows.
2. Blocks are dealt over all tasks.  At each boundary two Z-functions tell how far
   every distance repeats forwards and backwards; a distance that is a multiple
   of the stretch's own period belongs to another octave and is left out there.
3. Fragments are shuffled by document and period and stitched where they share
   as many words as the period has, which no two runs of one period do.
4. Documents with blocks meet their runs again; what a run holds behind its first
   period is cut out.

Words ``[^\\x20\\x09-\\x0D]+`` are told by 64-bit hashes.  Null, empty and blank
texts have no words and no runs.  Repeated rows are judged one by one, equal
exponents go to the run that starts first and then to the shorter period, an
empty table gives no rows, and further columns are left out.  A text of any
length is worked through whole: its words are held as offsets and hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Least length of a run in words, and in periods.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Words of a block of tiles, beside a tile that is larger by itself.
BLOCK = 1 << 16
#: Bytes of text, or of blocks, that are worked on at once.
SLICE = 1 << 20
#: Words up to this length are hashed side by side, longer ones each by a digest.
SHORT = 48

_MIX = np.random.default_rng(20260517).integers(1, 1 << 63, SHORT + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False

#: Where the end of a text is made periodic: (doc_id, number of words) to (first word, period), or None.
Tail = Callable[[int | None, int], tuple[int, int] | None]


def word_edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets at which the words of a text start and end."""
    found, before = [], False
    for start in range(0, len(raw), SLICE):
        solid = _SOLID[raw[start : start + SLICE]]
        changes = np.flatnonzero(solid != np.concatenate([[before], solid[:-1]])) + start
        found.append(changes.astype(np.int32))
        before = solid[-1]
    if before:
        found.append(np.array([len(raw)], np.int32))
    edges = np.concatenate([*found, np.empty(0, np.int32)])
    return edges[::2], edges[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: a sum of its bytes times random numbers by place."""
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE)))
        at, lengths = starts[first:last].astype(np.int64), (ends[first:last] - starts[first:last]).astype(np.int64)
        cut = np.minimum(lengths, SHORT)
        begins = np.cumsum(cut) - cut
        within = np.arange(int(cut.sum())) - np.repeat(begins, cut)
        values = (raw[np.repeat(at, cut) + within].astype(np.uint64) + np.uint64(1)) * _MIX[within]
        summed = np.add.reduceat(values, begins) + lengths.astype(np.uint64) * _MIX[SHORT]
        for i in np.flatnonzero(lengths > SHORT):
            digest = hashlib.blake2b(raw[at[i] : at[i] + lengths[i]], digest_size=8).digest()
            summed[i] = np.frombuffer(digest, np.uint64)[0]
        hashes[first:last] = summed
        first = last
    return hashes


def boundaries(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each octave S, the boundaries at which a run of the octave may lie."""
    n, size, windows = len(hashes), 1, hashes
    while max(LEAST_WORDS, LEAST_TIMES * size) <= n:
        # Row j holds the windows at distances S to 2S - 1 from boundary j * S.
        count = len(windows) - size
        rows = -(-count // size)
        later = np.zeros(rows * size, np.uint64)
        later[:count] = windows[size:]
        same = later.reshape(rows, size) == windows[: rows * size : size, None]
        if same.any():
            same.reshape(-1)[count:] = False
            twice = np.flatnonzero((same[:-1] & same[1:]).any(axis=1))
            if len(twice):
                yield size, np.union1d(twice, twice + 1) * size
        mixed = (windows[:-size] ^ (windows[:-size] >> np.uint64(29))) * _MIX[SHORT + 1]
        windows = mixed + windows[size:] * _MIX[SHORT + 2]
        size *= 2


def blocks(n: int, size: int, found: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """First and last word (excluded), first and last boundary of the blocks of one octave's tiles."""
    most, start = max(0, BLOCK - 5 * size), 0
    for place in range(1, len(found) + 1):
        ends = place == len(found)
        if ends or found[place] - found[place - 1] > 5 * size or found[place] - found[start] > most:
            first, last = int(found[start]), int(found[place - 1])
            yield max(0, first - size), min(n, last + 4 * size), first, last
            start = place


def z_function(word: list[int]) -> list[int]:
    """For each place, how many letters from there on equal the beginning."""
    n = len(word)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and word[k] == word[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def is_power(period: int, ahead: list[int]) -> bool:
    """Whether the first ``period`` letters are a shorter word repeated, by their Z-function."""
    divisor = 1
    while divisor * divisor <= period:
        if period % divisor == 0:
            for part in {divisor, period // divisor}:
                if part < period and ahead[part] >= period - part:
                    return True
        divisor += 1
    return False


def solve(codes: list[int], lo: int, first: int, last: int, size: int, n: int) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end) of a block that begins at word ``lo`` of ``n``."""
    found: list[tuple[int, int, int]] = []
    for c in range(first, last + 1, size):
        start, end = max(0, c - size), min(n, c + 4 * size)
        ahead = z_function(codes[c - lo : end - lo])
        periods = [p for p in range(size, min(2 * size, len(ahead))) if ahead[p] >= size and not is_power(p, ahead)]
        if not periods:
            continue
        before, reach = codes[start - lo : c - lo], min(n, c + 2 * size)
        behind = z_function([*reversed(before), -1, *reversed(codes[start - lo : reach - lo])])
        for p in periods:
            since = c - behind[len(before) + 1 + reach - c - p] if before else c
            until = c + p + ahead[p]
            whole = (since > start or start == 0) and (until < end or end == n)
            if not whole or until - since >= max(LEAST_WORDS, LEAST_TIMES * p):
                found.append((p, since, until))
    found.sort()
    stitched: list[tuple[int, int, int]] = []
    for p, since, until in found:
        if stitched and stitched[-1][0] == p and since + p <= stitched[-1][2]:
            stitched[-1] = (p, stitched[-1][1], max(until, stitched[-1][2]))
        else:
            stitched.append((p, since, until))
    return stitched


def tail_places(n: int, tail: tuple[int, int] | None) -> np.ndarray | None:
    """Which original word stands at each place; None where every word stays."""
    if tail is None:
        return None
    start, period = tail
    places = np.arange(n)
    places[start:] = start + (places[start:] - start) % period
    return places


def joined(raw: memoryview, starts: np.ndarray, ends: np.ndarray, places: np.ndarray | None) -> str:
    """Digest of the words at ``places`` (None: all), joined by one space."""
    digest, step = hashlib.sha256(), 1 << 17
    count = len(starts) if places is None else len(places)
    for at in range(0, count, step):
        if places is None:
            last = min(at + step, count)
            part = b" ".join(bytes(raw[int(starts[at]) : int(ends[last - 1])]).split())
        else:
            some = places[at : at + step]
            part = b" ".join([raw[s:e] for s, e in zip(starts[some].tolist(), ends[some].tolist())])
        digest.update(b" " + part if at else part)
    return digest.hexdigest()


TILED = pa.schema(
    [
        *[(name, pa.int64()) for name in ("row_id", "doc_id", "n", "tail_start", "tail_period")],
        ("tiled", pa.bool_()),
        ("text", pa.string()),
        ("collapsed_sha256", pa.string()),
        *[(name, pa.int64()) for name in ("size", "lo", "first", "last")],
        ("codes", pa.binary()),
    ]
)
TILED_DDL = (
    "row_id bigint, doc_id bigint, n bigint, tail_start bigint, tail_period bigint, tiled boolean, text string, "
    "collapsed_sha256 string, size bigint, lo bigint, first bigint, last bigint, codes binary"
)


def tiles(documents: DataFrame, tail: Tail | None = None) -> DataFrame:
    """A row for every document, and one for every block of its tiles; stored."""

    def tiled(batches):
        row_id = TaskContext.get().partitionId() << 33
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                row_id += 1
                buffer = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                raw = np.frombuffer(buffer, np.uint8)
                starts, ends = word_edges(raw)
                n = len(starts)
                made = tail(doc_id, n) if tail and n else None
                places = tail_places(n, made)
                hashes = word_hashes(raw, starts, ends)
                if places is not None:
                    hashes = hashes[places]
                any_block = False
                for octave, found in boundaries(hashes):
                    for lo, hi, first, last in blocks(n, octave, found):
                        codes = np.unique(hashes[lo:hi], return_inverse=True)[1].astype("<i4").tobytes()
                        block = {"row_id": row_id, "n": n, "size": octave, "lo": lo, "first": first, "last": last}
                        rows.append(block | {"codes": codes})
                        any_block, size = True, size + len(codes)
                        if size > SLICE:
                            yield pa.RecordBatch.from_pylist(rows, schema=TILED)
                            rows, size = [], 0
                row = {"row_id": row_id, "doc_id": doc_id, "n": n, "tiled": any_block}
                if made:
                    row |= {"tail_start": made[0], "tail_period": made[1]}
                if any_block:
                    row["text"] = text.as_py()
                    size += len(raw)
                else:
                    row["collapsed_sha256"] = joined(memoryview(buffer), starts, ends, places)
                rows.append(row)
                size += 100
                if size > SLICE:
                    yield pa.RecordBatch.from_pylist(rows, schema=TILED)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=TILED)

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows are told by numbers that only hold as written, so they are stored.
    return common.stored(plain.mapInArrow(tiled, TILED_DDL), "run-tiles", compression="zstd")


def fragments(tiled: DataFrame) -> DataFrame:
    """Stretches (row_id, period, start, end) found in single blocks."""

    def solved(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], "<i4").tolist()
                found = solve(codes, row["lo"], row["first"], row["last"], row["size"], row["n"])
                columns = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["row_id"]] * len(found), pa.int64()), *[pa.array(c, pa.int64()) for c in columns]],
                    names=["row_id", "period", "start", "end"],
                )

    found = tiled.filter("codes is not null").select("row_id", "n", "size", "lo", "first", "last", "codes")
    dealt = found.repartition("row_id", "size", "lo")
    return dealt.mapInArrow(solved, "row_id bigint, period bigint, start bigint, end bigint")


def stitched(found: DataFrame) -> DataFrame:
    """Runs (row_id, start, length, period) from fragments, each under its least period."""
    by_period = Window.partitionBy("row_id", "period").orderBy("start", "end")
    reach = F.max("end").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") + F.col("period") > reach).cast("int"), F.lit(1))
    stretch = F.sum("apart").over(by_period)
    length = F.col("until") - F.col("start")
    return (
        found.withColumn("apart", apart)
        .withColumn("stretch", stretch)
        .groupBy("row_id", "period", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("until"))
        .withColumn("length", length)
        .filter(F.col("length") >= F.greatest(F.lit(LEAST_WORDS).cast("long"), LEAST_TIMES * F.col("period")))
        .groupBy("row_id", "start", "length")
        .agg(F.min("period").alias("period"))
    )


def runs(documents: DataFrame, tail: Tail | None = None) -> DataFrame:
    """Every document with the list of its runs, and the digest of its words without what runs repeat."""
    tiled = tiles(documents, tail)
    own = stitched(fragments(tiled)).groupBy(F.col("row_id").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    held = tiled.filter("codes is null")
    names = ["doc_id", "n", "runs", "collapsed_sha256"]
    none = F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")

    def collapsed(batches):
        for batch in batches:
            digests = []
            for text, found, start, period in zip(*[batch[c] for c in ("text", "runs", "tail_start", "tail_period")]):
                buffer = text.as_buffer()
                starts, ends = word_edges(np.frombuffer(buffer, np.uint8))
                places = tail_places(len(starts), (start.as_py(), period.as_py()) if start.is_valid else None)
                places = np.arange(len(starts)) if places is None else places
                kept = np.ones(len(starts), bool)
                for run in found.as_py():
                    kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
                digests.append(joined(memoryview(buffer), starts, ends, places[kept]))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names[:3]], pa.array(digests, pa.string())], names=names)

    met = (
        held.filter("tiled")
        .join(own, F.col("row_id") == F.col("of"), "left")
        .select("doc_id", "n", F.coalesce("runs", none).alias("runs"), "text", "tail_start", "tail_period")
        .mapInArrow(collapsed, "doc_id bigint, n bigint, runs array<struct<start:bigint,period:bigint,length:bigint>>, collapsed_sha256 string")
    )
    others = held.filter("not tiled").select("doc_id", "n", none.alias("runs"), "collapsed_sha256")
    return met.unionByName(others)


def greatest(found: Column) -> Column:
    """The run of the greatest exact exponent; of equal ones the first start, then the shorter period."""

    def better(best: Column, run: Column) -> Column:
        left, right = run["length"] * best["period"], best["length"] * run["period"]
        tie = F.struct(run["start"], run["period"]) < F.struct(best["start"], best["period"])
        return F.when(best.isNull() | (left > right) | ((left == right) & tie), run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")
    return F.aggregate(found, none, better)


def digests(documents: DataFrame) -> DataFrame:
    """Number of runs, the greatest one and digests of all, from the rows of :func:`runs`."""
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    best = documents.withColumn("best", greatest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
