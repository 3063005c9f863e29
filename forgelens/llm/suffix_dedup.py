"""Suffix-array dedup: cut passages that a document with a smaller id holds too.

Every byte goes that is covered by a string of ``LENGTH`` bytes which also
starts in a document with a smaller ``doc_id``.  Suffixes are told apart by
their first ``LENGTH`` bytes, which deep-shallow sorting puts in order; strings
that are equal end up side by side, and the least document of each is known.

Only suffixes that can have an equal are sorted.  Every string has an anchor,
the place of the least hash among its runs of ``RUN`` bytes, and equal strings
have equal anchors at the same place.  So texts are packed into chunks and

1. a chunk sends the hashes of its anchors, each once, to buckets by hash;
2. a bucket answers which of them more than one document has;
3. a chunk sends the strings around those anchors, strings in a row that share
   an anchor as one piece, each different piece once with its least document;
4. a bucket joins equal pieces, sorts the suffixes of pieces that share an
   anchor's hash, and answers with documents smaller than the chunk's own;
5. a chunk cuts what its documents share with smaller ones.

A piece that many documents share costs one entry per chunk.  An anchor that
more than ``HOT_CHUNKS`` chunks have is sent as single strings, spread by their
own hash, so that no bucket gathers all that follows a frequent phrase.

Null and empty texts have no bytes.  Rows without a ``doc_id`` lose nothing and
make no other lose anything.  Rows of one ``doc_id`` count as one document, so
they lose nothing to each other.  An empty table gives no rows.  Columns asked
for travel in ``row``, so no name can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, deep_shallow
from .shingles import mix

LENGTH = 50
RUN = 20
#: Text per chunk, and per bucket on average.
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: Bytes of text whose anchors are computed at once, beside a text that is longer by itself.
SOME_BYTES = 512 << 10
#: Strings that are sorted at once, beside those of one anchor.
SOME_STRINGS = 100_000
HOT_CHUNKS = 1000

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_HASH_BITS = 48
_PLACE = _U64((1 << 32) - 1)
_NO_ID = np.iinfo(np.int64).max


def run_hashes(data: np.ndarray, run: int) -> np.ndarray:
    """A 64-bit hash of every run of bytes, the same wherever the run stands."""
    powers = np.full(len(data) + 1, _U64(_BASE))
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    back = np.full(len(data) + 1, _U64(pow(_BASE, -1, 1 << 64)))
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, _U64), np.cumsum((data.astype(_U64) + _U64(1)) * powers[:-1])])
    count = len(data) - run + 1
    return mix((sums[run:] - sums[:count]) * back[:count])


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@dataclass
class Pieces:
    """Strings in a row that share an anchor: where the first starts, how many, and the anchor's hash."""

    starts: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def anchored(data: np.ndarray, bounds: np.ndarray, length: int, run: int) -> Pieces:
    """All strings of ``length`` bytes within the texts that ``bounds`` separate, grouped by their anchor.

    Some texts at a time, since what is computed takes many times their room.
    """
    found = []
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SOME_BYTES, "right")) - 1)
        base = bounds[first]
        some = _anchored(data[base : bounds[last]], bounds[first : last + 1] - base, length, run)
        found.append(Pieces(some.starts + base, some.counts, some.hashes, some.rows + first))
        first = last
    return Pieces(
        *[
            np.concatenate([getattr(one, name) for one in found]) if found else np.zeros(0, dtype=kind)
            for name, kind in (("starts", np.int64), ("counts", np.int64), ("hashes", _U64), ("rows", np.int64))
        ]
    )


def _anchored(data: np.ndarray, bounds: np.ndarray, length: int, run: int) -> Pieces:
    if not (np.diff(bounds) >= length).any():
        return Pieces(*[np.zeros(0, dtype=np.int64)] * 2, np.zeros(0, dtype=_U64), np.zeros(0, dtype=np.int64))
    hashes = run_hashes(data, run)
    # Upper half of the hash, then the place: the least is the first of the least hash.
    marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=_U64)
    anchor = least_in_window(marked, length - run + 1) & _PLACE
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + length <= bounds[1:][row])
    anchor = anchor[starts]
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)])
    begin = np.flatnonzero(fresh)
    counts = np.diff(np.concatenate([begin, [len(starts)]]))
    first = starts[begin]
    # The least of many hashes are small ones: mixed again, they fill all buckets alike.
    return Pieces(first, counts, mix(hashes[anchor[begin]]) >> _U64(64 - _HASH_BITS), row[first])


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their weight, which packs well where high bytes repeat."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


class Chunk:
    """Some texts with their ids, and what all steps derive from them in the same way."""

    def __init__(self, ids: list[int | None], lengths: list[int], blob: bytes, length: int, run: int):
        self.ids = np.array([_NO_ID if i is None else i for i in ids], dtype=np.int64)
        self.named = np.array([i is not None for i in ids], dtype=bool)
        self.blob, self.length = blob, length
        self.data = np.frombuffer(blob, dtype=np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(np.array(lengths, dtype=np.int64))])
        found = anchored(self.data, self.bounds, length, run)
        use = self.named[found.rows] if len(found.rows) else np.zeros(0, dtype=bool)
        self.pieces = Pieces(found.starts[use], found.counts[use], found.hashes[use], found.rows[use])
        self.hashes, self.hash_of = np.unique(self.pieces.hashes, return_inverse=True)

    def several(self) -> np.ndarray:
        """Which hashes more than one document of this chunk has."""
        owner = self.ids[self.pieces.rows]
        least = np.full(len(self.hashes), _NO_ID)
        most = np.full(len(self.hashes), np.iinfo(np.int64).min)
        np.minimum.at(least, self.hash_of, owner)
        np.maximum.at(most, self.hash_of, owner)
        return least < most

    def cut(self, answers: dict[int, bytes], buckets: int) -> None:
        """Pieces whose anchor others have too (``answers``: packed bits by bucket), and their classes."""
        shared = np.zeros(len(self.hashes), dtype=bool)
        hot = np.zeros(len(self.hashes), dtype=bool)
        for bucket, begin, end in slices(self.hashes, buckets):
            bits = np.unpackbits(np.frombuffer(answers[bucket], dtype=np.uint8))
            shared[begin:end] = bits[: end - begin]
            hot[begin:end] = bits[end - begin : 2 * (end - begin)]
        take = np.flatnonzero(shared[self.hash_of])
        split = hot[self.hash_of[take]]
        counts = self.pieces.counts[take]
        times = np.where(split, counts, 1)
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        starts = np.repeat(self.pieces.starts[take], times) + inner
        widths = np.where(np.repeat(split, times), 1, np.repeat(counts, times))
        owners = self.ids[np.repeat(self.pieces.rows[take], times)]
        targets = (np.repeat(self.pieces.hashes[take], times) * _U64(buckets) >> _U64(_HASH_BITS)).astype(np.int64)
        alone = np.repeat(split, times)
        order = np.argsort(owners, kind="stable")
        self.starts, self.widths, self.owners = starts[order], widths[order], owners[order]
        # Documents come in the order of their ids, so a class begins with its least one.
        known: dict[bytes, int] = {}
        ends = self.starts + self.widths + (self.length - 1)
        blob = self.blob
        self.class_of = np.array(
            [known.setdefault(blob[a:b], len(known)) for a, b in zip(self.starts.tolist(), ends.tolist())],
            dtype=np.int64,
        )
        self.contents = list(known)
        firsts = np.unique(self.class_of, return_index=True)[1]
        self.least = self.owners[firsts]
        self.class_widths = self.widths[firsts]
        self.targets = targets[order][firsts]
        for one in np.flatnonzero(alone[order][firsts]).tolist():
            self.targets[one] = zlib.crc32(self.contents[one]) * buckets >> 32

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """Classes of each bucket, in a fixed order."""
        order = np.argsort(self.targets, kind="stable")
        found = self.targets[order]
        edges = np.flatnonzero(np.concatenate([[len(found) > 0], np.diff(found) != 0, [len(found) > 0]]))
        for begin, end in zip(edges[:-1], edges[1:]):
            yield int(found[begin]), order[begin:end]

    def covered(self, answers: dict[int, bytes]) -> np.ndarray:
        """Which bytes go, after the buckets named the least documents (``answers`` by bucket)."""
        begins = np.concatenate([[0], np.cumsum(self.class_widths)])
        least = np.repeat(self.least, self.class_widths)
        for bucket, classes in self.by_bucket():
            if bucket in answers:
                places, documents = unpack_least(answers[bucket])
                widths = self.class_widths[classes]
                offset = np.repeat(begins[classes] - (np.cumsum(widths) - widths), widths)
                least[places + offset[places]] = documents
        total = int(self.widths.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(self.widths) - self.widths, self.widths)
        smaller = least[np.repeat(begins[self.class_of], self.widths) + inner] < np.repeat(self.owners, self.widths)
        starts = (np.repeat(self.starts, self.widths) + inner)[smaller]
        size = len(self.data) + 1
        change = np.bincount(starts, minlength=size) - np.bincount(starts + self.length, minlength=size)
        return np.cumsum(change)[: len(self.data)] > 0


def slices(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Bucket, begin and end of each run of sorted ``hashes`` that belong to one bucket."""
    found = hashes * _U64(buckets) >> _U64(_HASH_BITS)
    edges = np.flatnonzero(np.concatenate([[len(found) > 0], np.diff(found) != 0, [len(found) > 0]]))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(found[begin]), begin, end


def pack_least(places: np.ndarray, documents: np.ndarray) -> bytes:
    """Places (growing) and the documents named there, by runs of one document."""
    fresh = np.concatenate([[True], (np.diff(places) != 1) | (np.diff(documents) != 0)]) if len(places) else []
    begin = np.flatnonzero(fresh)
    lengths = np.diff(np.concatenate([begin, [len(places)]]))
    gaps = np.diff(np.concatenate([[0], places[begin]]))
    return _pack(_planes(np.concatenate([gaps, lengths, documents[begin]]).astype(np.int64).view(np.uint64)))


def unpack_least(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    gaps, lengths, documents = np.split(_from_planes(_unpack(data)).view(np.int64), 3)
    begins = np.cumsum(gaps)
    inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(begins, lengths) + inner, np.repeat(documents, lengths)


def shared_hashes(blocks: list[bytes], hot_chunks: int) -> list[bytes]:
    """For each chunk's block, bits of the hashes that another document has, and of those that are hot."""
    parts, flags = [], []
    for block in blocks:
        raw = _unpack(block)
        count = len(raw) // 9
        parts.append(np.cumsum(_from_planes(raw[: 8 * count])))
        flags.append(np.frombuffer(raw[8 * count :], dtype=np.uint8))
    _, number, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    several = np.zeros(len(times), dtype=bool)
    several[number[np.concatenate(flags) > 0]] = True
    shared, hot = (several | (times > 1))[number], (times > hot_chunks)[number]
    edges = np.cumsum([0, *map(len, parts)])
    return [
        np.packbits(np.concatenate([shared[a:b], hot[a:b]])).tobytes() for a, b in zip(edges[:-1], edges[1:])
    ]


def pack_classes(contents: list[bytes], least: np.ndarray) -> bytes:
    lengths = np.array([len(c) for c in contents], dtype="<u4")
    head = np.array([len(contents)], dtype="<u4").tobytes()
    return _pack(head + lengths.tobytes() + _planes(least.view(np.uint64)) + b"".join(contents))


def unpack_classes(data: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = _unpack(data)
    count = int(np.frombuffer(raw, dtype="<u4", count=1)[0])
    lengths = np.frombuffer(raw, dtype="<u4", offset=4, count=count)
    least = _from_planes(raw[4 + 4 * count : 4 + 12 * count]).view(np.int64)
    edges = (np.cumsum(np.concatenate([[0], lengths])) + 4 + 12 * count).tolist()
    return [raw[a:b] for a, b in zip(edges[:-1], edges[1:])], least


def runs_of(keys: np.ndarray, weights: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of sorted ``keys`` that cut no key apart, each of about ``most`` in weight or one key."""
    if not len(keys):
        return
    edges = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0]))
    before = np.concatenate([[0], np.cumsum(weights)])[edges]
    start = 0
    while start < len(edges):
        stop = max(start + 1, int(np.searchsorted(before, before[start] + most, "right")) - 1)
        if before[-1] <= before[start] + most:
            stop = len(edges)
        yield slice(int(edges[start]), int(edges[stop]) if stop < len(edges) else len(keys))
        start = stop


def anchors_of(joined: np.ndarray, starts: np.ndarray, sizes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of each piece's anchor: its least run, as in the chunk it comes from."""
    places, anchors = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=_U64)
    for some in runs_of(np.arange(len(starts)), sizes, SOME_BYTES):
        base, own = starts[some.start], sizes[some]
        hashes = run_hashes(joined[base : base + own.sum()], run)
        marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=_U64)
        # Runs across the border of two pieces do not count.
        first = starts[some] - base
        inside = np.arange(own.sum()) - np.repeat(first, own) + run <= np.repeat(own, own)
        marked[~inside[: len(marked)]] = ~_U64(0)
        least = (np.minimum.reduceat(marked, first) & _PLACE).astype(np.int64)
        places[some], anchors[some] = least + base, hashes[least]
    return places, anchors


def least_documents(blocks: list[bytes], length: int, run: int) -> list[bytes | None]:
    """For each chunk's block of classes, the strings for which another chunk has a smaller document."""
    known: dict[bytes, int] = {}
    numbers, own = [], []
    for block in blocks:
        contents, least = unpack_classes(block)
        numbers.append(np.array([known.setdefault(c, len(known)) for c in contents], dtype=np.int64))
        own.append(least)
    total = np.full(len(known), _NO_ID)
    np.minimum.at(total, np.concatenate(numbers), np.concatenate(own))
    sizes = np.array([len(c) for c in known], dtype=np.int64)
    widths = sizes - (length - 1)
    begins = np.concatenate([[0], np.cumsum(widths)])
    least = np.repeat(total, widths)
    joined = np.frombuffer(b"".join(known), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    place, anchor = anchors_of(joined, starts, sizes, run)
    _, anchor, times = np.unique(anchor, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(times[anchor] > 1)
    mixed = mixed[np.argsort(anchor[mixed], kind="stable")]
    for some in runs_of(anchor[mixed], widths[mixed], SOME_STRINGS):
        pieces = mixed[some]
        counts = widths[pieces]
        piece = np.repeat(pieces, counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[piece] + inner
        # Equal strings have equal anchors at the same distance.
        group = np.unique(anchor[piece] * (1 << 20) + (place[piece] - at), return_inverse=True)[1]
        order, classes = deep_shallow.sort(deep_shallow.as_words(joined, at, length), group)
        edges = np.flatnonzero(np.concatenate([[True], np.diff(classes) != 0]))
        slots = (begins[piece] + inner)[order]
        least[slots] = np.minimum.reduceat(total[piece][order], edges)[classes]
    answers: list[bytes | None] = []
    for number, mine in zip(numbers, own):
        counts = widths[number]
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found = least[np.repeat(begins[number], counts) + inner]
        places = np.flatnonzero(found < np.repeat(mine, counts))
        answers.append(pack_least(places, found[places]) if len(places) else None)
    return answers


def in_chunks(documents: DataFrame, keep: list[str], chunk_bytes: int) -> DataFrame:
    """Chunks of whole texts: id, ids, lengths and packed bytes, and the columns ``keep`` of their rows."""
    rows = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    schema = (
        rows.select(
            F.lit(0).cast("long").alias("chunk"),
            F.array("doc_id").alias("ids"),
            F.array(F.lit(0).cast("long")).alias("lengths"),
            F.col("text").alias("blob"),
            F.array("row").alias("rows"),
        )
    ).schema

    def packed(batches):
        first = TaskContext.get().partitionId() << 32
        number, held, size = 0, [], 0

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            texts = table["text"].to_pylist()
            one = table["row"].combine_chunks()
            one = one if isinstance(one, pa.StructArray) else pa.concat_arrays(one.chunks)
            offsets = pa.array([0, len(texts)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number], pa.int64()),
                    pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(text) for text in texts]], pa.list_(pa.int64())),
                    pa.array([_pack(b"".join(texts))], pa.binary()),
                    pa.ListArray.from_arrays(offsets, one),
                ],
                names=["chunk", "ids", "lengths", "blob", "rows"],
            )

        for batch in batches:
            begin = 0
            for place, value in enumerate(batch["text"]):
                size += len(value.as_buffer())
                if size >= chunk_bytes:
                    held.append(batch.slice(begin, place + 1 - begin))
                    yield chunk()
                    begin, number, held, size = place + 1, number + 1, [], 0
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield chunk()

    return rows.mapInArrow(packed, schema)


def shared_strings(
    documents: DataFrame,
    keep: list[str] = ("doc_id",),
    length: int = LENGTH,
    run: int = RUN,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_chunks: int = HOT_CHUNKS,
    whole_characters: bool = False,
) -> DataFrame:
    """Per row of ``documents``: ``row`` (columns ``keep``), n_bytes, spans cut (begin, end), and ``left``.

    ``left`` is what remains, as bytes.  With ``whole_characters`` a character
    stays that is covered in part only, so that ``left`` is text.
    """
    chunks = common.stored(in_chunks(documents, keep, chunk_bytes), "suffix-chunks")
    total = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    def loaded(ids, lengths, blob) -> Chunk:
        return Chunk(ids, lengths, _unpack(blob), length, run)

    def each(batches) -> Iterator[tuple[int, Chunk]]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield (
                    batch["chunk"][k].as_py(),
                    loaded(batch["ids"][k].as_py(), batch["lengths"][k].as_py(), batch["blob"][k].as_py()),
                )

    def from_table(table: pa.Table) -> Chunk:
        return loaded(table["ids"][0].as_py(), table["lengths"][0].as_py(), table["blob"][0].as_py())

    def blocks(rows: list[tuple[int, int, bytes]]) -> pa.Table:
        bucket, chunk, payload = zip(*rows) if rows else ((), (), ())
        return pa.table(
            {
                "bucket": pa.array(bucket, pa.int64()),
                "chunk": pa.array(chunk, pa.int64()),
                "payload": pa.array(payload, pa.binary()),
            }
        )

    def ask(batches):
        for number, chunk in each(batches):
            several = chunk.several().astype(np.uint8)
            rows = []
            for bucket, a, b in slices(chunk.hashes, buckets):
                gaps = np.diff(np.concatenate([np.zeros(1, _U64), chunk.hashes[a:b]]))
                rows.append((bucket, number, _pack(_planes(gaps) + several[a:b].tobytes())))
            yield from blocks(rows).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        found = shared_hashes(table["payload"].to_pylist(), hot_chunks)
        return pa.table({"bucket": table["bucket"], "chunk": table["chunk"], "payload": pa.array(found, pa.binary())})

    def payloads(table: pa.Table) -> dict[int, bytes]:
        return dict(zip(table["bucket"].to_pylist(), table["payload"].to_pylist()))

    def send(chunk_table: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk_table.num_rows or not answers.num_rows:
            return blocks([])
        number = chunk_table["chunk"][0].as_py()
        chunk = from_table(chunk_table)
        chunk.cut(payloads(answers), buckets)
        return blocks(
            [
                (bucket, number, pack_classes([chunk.contents[c] for c in classes], chunk.least[classes]))
                for bucket, classes in chunk.by_bucket()
            ]
        )

    def name(table: pa.Table) -> pa.Table:
        found = least_documents(table["payload"].to_pylist(), length, run)
        rows = zip(table["bucket"].to_pylist(), table["chunk"].to_pylist(), found)
        return blocks([row for row in rows if row[2] is not None])

    out_schema = T.StructType(
        [
            T.StructField("row", chunks.schema["rows"].dataType.elementType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType.fromDDL("begin bigint, end bigint"))),
            T.StructField("left", T.BinaryType()),
        ]
    )

    def finish(chunk_table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = from_table(chunk_table)
        if answers.num_rows:
            named = np.array(answers["kind"].to_pylist())
            first, second = (answers.filter(pa.array(named == kind)) for kind in ("shared", "least"))
            chunk.cut(payloads(first), buckets)
            gone = chunk.covered(payloads(second))
        else:
            gone = np.zeros(len(chunk.data), dtype=bool)
        if whole_characters and len(gone):
            begins = np.flatnonzero((chunk.data & 0xC0) != 0x80)
            gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff([*begins, len(gone)]))
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        # Texts begin anew: a cut that goes on from one text into the next is two.
        inner = chunk.bounds[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(gone))])
        on = inner[gone[inner] & gone[inner - 1]]
        begin = np.sort(np.concatenate([np.flatnonzero(edge == 1), on]))
        end = np.sort(np.concatenate([np.flatnonzero(edge == -1), on]))
        edges = np.searchsorted(begin, chunk.bounds)
        shift = np.repeat(chunk.bounds[:-1], np.diff(edges))
        cuts = pa.StructArray.from_arrays([pa.array(begin - shift), pa.array(end - shift)], names=["begin", "end"])
        kept = chunk.data[~gone].tobytes()
        ends = np.concatenate([[0], np.cumsum(~gone)])[chunk.bounds].tolist()
        rows = chunk_table["rows"].combine_chunks()
        rows = rows if isinstance(rows, pa.ListArray) else pa.concat_arrays(rows.chunks)
        return pa.table(
            {
                "row": rows.flatten(),
                "n_bytes": pa.array(np.diff(chunk.bounds)),
                "spans": pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), cuts),
                "left": pa.array([kept[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
            }
        )

    shape = "bucket bigint, chunk bigint, payload binary"
    bare = chunks.select("chunk", "ids", "lengths", "blob")
    asked = bare.mapInArrow(ask, shape)
    shared = common.stored(asked.groupBy("bucket").applyInArrow(answer, shape), "suffix-shared")
    sent = bare.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(send, shape)
    least = common.stored(sent.groupBy("bucket").applyInArrow(name, shape), "suffix-least")
    answers = shared.withColumn("kind", F.lit("shared")).unionByName(least.withColumn("kind", F.lit("least")))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, out_schema)


def digests(cut: DataFrame) -> list[Column]:
    """Bytes cut, number of cuts, and the digest of what is left."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return [
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("left", 256).alias("kept_sha256"),
    ]


def cut_repeats(documents: DataFrame, **options) -> DataFrame:
    """``documents`` without shared passages; ``n_chars``, where there is one, is counted anew."""
    # The text travels packed, so its rows carry the other columns only.
    others = F.struct(*[F.col(f"`{name}`") for name in documents.columns if name != "text"])
    rows = documents.select("doc_id", "text", others.alias("others"), F.col("text").isNull().alias("missing"))
    cut = shared_strings(rows, ["others", "missing"], whole_characters=True, **options)
    text = F.when(~F.col("row.missing"), F.col("left").cast("string"))
    new = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in documents.columns else {})
    return cut.select(*[new.get(name, F.col(f"row.others.`{name}`")).alias(name) for name in documents.columns])
