"""Alignment of two tokenizers' tokens over the bytes of a text, and how often their tokens meet.

A is a byte-level BPE of the tokenizers library, B a SentencePiece model that
puts a blank before each text; both encode the text's bytes after one blank.
The ends of A's tokens, summed byte lengths, are looked up among B's: two
dictionaries map ends to the number of tokens that end there, the sorted keys
they share cut both id lists into groups, and in each group the tokens that
overlap are linked.  Links are counted over the corpus as documents that hold a
pair of ids linked, and every document is measured against these counts.

Where neither tokenizer's tokens cross the border of a unit (:mod:`units`; of B
the vocabulary shows it), both end a token there, so a worker encodes and aligns
a unit once and puts texts together from their units.  With other models a whole
text is one unit.

A task closes a chunk of documents after ``CHUNK`` characters and stores it with
its distinct pairs, and the number of its documents that hold each.  The counts
of a pair are summed over chunks, given back to the chunks that hold the pair,
and added up there: a pair that occurs in most documents travels once a chunk.

Texts that are null or empty, or whose tokens do not give back their bytes (a
literal U+2581 is a blank to B), have no tokens: all numbers 0, empty digest.
Repeated rows are documents of their own, ties of a count all count as highest,
an empty table gives no rows, and further columns are left out.  A long text is
worked through in slices; only a unit of many MB is encoded at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, units
from .pieces import MARK, Model
from .units import byte_alphabet

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Characters of a chunk of documents, beside a text that is longer by itself.
CHUNK = 4 << 20
#: Units of a generation that a worker remembers.
KEPT = 350_000


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes.fromhex(piece[3:5])
    return piece.replace(MARK, " ").encode()


def groups(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the slices of both token lists stop that begin and end together."""
    at_a, at_b = dict(zip(ends_a, range(1, len(ends_a) + 1))), dict(zip(ends_b, range(1, len(ends_b) + 1)))
    shared = sorted(at_a.keys() & at_b.keys())
    return tuple(np.fromiter(map(at.__getitem__, shared), np.int64, len(shared)) for at in (at_a, at_b))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the tokens that overlap, and where they do: each range between neighbouring ends lies in one of each."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends


#: What is known of a text without tokens.
NOTHING = np.empty(0, np.int64), np.empty(0, np.int64), [0, 0, 0], ""


class Aligner:
    """Aligns texts; what was found out about units that came before is remembered."""

    def __init__(self, tokenizer_json: str, proto: bytes) -> None:
        import sentencepiece

        self.a = units.ByteLevel(tokenizer_json, plain_special=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto)
        model = Model.parse(proto)
        self.cut = self.a.cut and model.splits_at_words() and model.dummy_prefix
        alphabet, vocabulary = byte_alphabet(), self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b = [piece_bytes(piece) for piece in model.pieces]
        self.lengths_a, self.lengths_b = (np.array([*map(len, of)]) for of in (self.bytes_a, self.bytes_b))
        # Every id as text with what may follow it: within its side of a group, and at the end of that.
        self.texts = [f"{i}{mark}" for side, of in (("|", self.bytes_a), (";", self.bytes_b)) for i in range(len(of)) for mark in (",", side)]
        self.line_end = len(self.b.encode("\n"))
        self.alone = [self.b.piece_to_id(MARK)]
        self.memory = units.Memory(KEPT)

    def _encode_b(self, found: list[str]) -> list[list[int]]:
        """B's ids; it puts a blank before each text, which most units have already."""
        blank = [unit.startswith(" ") for unit in found]
        ids = self.b.encode([unit[1:] if has else "\n" + unit for unit, has in zip(found, blank)], num_threads=1)
        return [
            self.alone if unit == " " else one if has else one[self.line_end :]
            for unit, has, one in zip(found, blank, ids)
        ]

    def _learn(self, new: list[str]) -> bool:
        """Align units, all at once; False if the tokens of one of them do not give back its bytes.

        Of each unit are kept: the text of its groups, its packed links, and its numbers of tokens and groups.
        """
        new, ids_a, tokens_a = self.a.encode(new)
        of_b = self._encode_b(new)
        wholes = [unit.encode() for unit in new]
        ids_b, tokens_b = np.fromiter(chain.from_iterable(of_b), np.int64), np.cumsum([*map(len, of_b)])
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        # All bytes in a row are the same, and a token ends with each unit: so are those of every unit.
        borders, together = np.cumsum([*map(len, wholes)]), b"".join(wholes)
        for of, ids, ends, tokens in ((self.bytes_a, ids_a, ends_a, tokens_a), (self.bytes_b, ids_b, ends_b, tokens_b)):
            if not len(ids) or tokens[0] == 0 or not np.array_equal(ends[tokens - 1], borders):
                return False
            if b"".join(map(of.__getitem__, ids.tolist())) != together:
                return False
        stops_a, stops_b = groups(ends_a.tolist(), ends_b.tolist())
        # A's ids of a group stand before B's; an id's text tells whether it is the last of its side.
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        for ids, stops, others, first in (
            (ids_a, stops_a, np.concatenate([[0], stops_b[:-1]]), 0),
            (ids_b, stops_b, stops_a, 2 * len(self.bytes_a)),
        ):
            last = np.zeros(len(ids), np.int64)
            last[stops - 1] = 1
            before = np.repeat(others, np.diff(stops, prepend=0))
            codes[np.arange(len(ids)) + before] = first + 2 * ids + last
        texts = [*map(self.texts.__getitem__, codes.tolist())]
        place_a, place_b, where = links(ends_a, ends_b)
        packed = (ids_a[place_a] << 32 | ids_b[place_b]).tobytes()
        # Both tokenizers end a token where a unit ends, so that all lists are cut there.
        at_group = np.searchsorted(stops_a, tokens_a, side="right")
        at_link = 8 * np.searchsorted(where, borders, side="right")
        text, link, group = 0, 0, 0
        for unit, a, b, text_end, link_end, group_end in zip(
            new, np.diff(tokens_a, prepend=0).tolist(), map(len, of_b), (tokens_a + tokens_b).tolist(), at_link.tolist(), at_group.tolist()
        ):
            own = "".join(texts[text:text_end])[:-1], packed[link:link_end], a, b, group_end - group
            self.memory.known[unit] = own
            text, link, group = text_end, link_end, group_end
        return True

    def _of_units(self, found: list[str], digest, place: int) -> tuple[tuple[np.ndarray, np.ndarray], list[int]]:
        """Distinct links and how often each occurs, and numbers of tokens and groups; the groups go to ``digest``."""
        texts, packed, *counts = zip(*map(self.memory.known.__getitem__, found))
        digest.update(((";" if place else "") + ";".join(texts)).encode())
        return np.unique(np.frombuffer(b"".join(packed), np.int64), return_counts=True), [*map(sum, counts)]

    def document(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[int], str]:
        """Distinct links, how often each occurs, numbers of tokens and groups, and the groups' digest."""
        if not text:
            return NOTHING
        digest, numbers, kept = hashlib.sha256(), [0, 0, 0], []
        for place, found in enumerate(units.slices(" " + text, self.cut)):
            new = self.memory.missing(found)
            if new and not self._learn(new):
                return NOTHING
            links_found, more = self._of_units(found, digest, place)
            numbers = [so_far + one for so_far, one in zip(numbers, more)]
            kept.append(links_found)
            self.memory.drop_long(new)
        pairs, times = kept[0]
        if len(kept) > 1:
            pairs, inverse = np.unique(np.concatenate([one for one, _ in kept]), return_inverse=True)
            times = np.bincount(inverse, np.concatenate([n for _, n in kept]), len(pairs)).astype(np.int64)
        return pairs, times, numbers, digest.hexdigest()

    def documents(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, list[int], str]]:
        """The same of each of some texts, whose new units are aligned at once; one text alone may be long."""
        # A literal mark is not given back, so it would fail the units of the other texts.
        found = [
            [*chain.from_iterable(units.slices(" " + text, self.cut))] if text and MARK not in text else [] for text in texts
        ]
        new = self.memory.missing([*chain.from_iterable(found)]) if len(texts) > 1 else []
        if len(texts) == 1 or (new and not self._learn(new)):
            return [self.document(text) for text in texts]
        results = []
        for one in found:
            digest = hashlib.sha256()
            if one:
                (pairs, times), numbers = self._of_units(one, digest, 0)
            results.append((pairs, times, numbers, digest.hexdigest()) if one else NOTHING)
        self.memory.drop_long(new)
        # These make room in the memory, so they come after the others.
        return [self.document(text) if MARK in text else one for text, one in zip(texts, results)]


@lru_cache(maxsize=1)
def aligner_of(tokenizer_json: str, proto: bytes) -> Aligner:
    return Aligner(tokenizer_json, proto)


ALIGNED = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")],
        ("groups_sha256", pa.string()),
        ("places", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("pairs", pa.list_(pa.int64())),
        ("holders", pa.list_(pa.int32())),
    ]
)
ALIGNED_DDL = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "places array<int>, times array<int>, pairs array<bigint>, holders array<int>"
)


def listed(parts: list[np.ndarray], kind) -> pa.ListArray:
    sizes = [0, *map(len, parts)]
    values = np.concatenate([*parts, np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values, kind))


def chunk_rows(chunk: int, doc_ids: list, found: list) -> Iterator[pa.RecordBatch]:
    """Rows of the documents of a chunk, and one more with its distinct pairs, to which ``places`` point."""
    pairs, places, holders = np.unique(
        np.concatenate([one[0] for one in found]), return_inverse=True, return_counts=True
    )
    borders = np.cumsum([len(one[0]) for one in found])[:-1]
    times = [one[1] for one in found]
    n = len(found)
    numbers = [pa.array([one[2][i] for one in found], pa.int64()) for i in range(3)]
    columns = [
        pa.array([chunk] * n, pa.int64()),
        pa.array(doc_ids, pa.int64()),
        *numbers,
        pa.array([int(one.sum()) for one in times], pa.int64()),
        pa.array([one[3] for one in found], pa.string()),
        listed(np.split(places, borders), pa.int32()),
        listed(times, pa.int32()),
        pa.nulls(n, ALIGNED.field("pairs").type),
        pa.nulls(n, ALIGNED.field("holders").type),
    ]
    yield pa.RecordBatch.from_arrays(columns, schema=ALIGNED)
    if len(pairs):
        whole = {"chunk": chunk, "pairs": pairs, "holders": holders.astype(np.int32)}
        yield pa.RecordBatch.from_pylist([whole], schema=ALIGNED)


def align(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Numbers and digest of every document's alignment by chunk, and the pairs of each chunk; stored."""
    with open(byte_bpe, encoding="utf-8") as file:
        tokenizer_json = file.read()
    with open(piece_bpe, "rb") as file:
        proto = file.read()

    def aligned(batches):
        aligner = aligner_of(tokenizer_json, proto)
        chunk, doc_ids, found, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            of_batch = iter(batch["doc_id"].to_pylist())
            for texts in units.runs(text.as_py() or "" for text in batch["text"]):
                doc_ids += islice(of_batch, len(texts))
                found += aligner.documents(texts)
                size += sum(map(len, texts))
                if size > CHUNK:
                    yield from chunk_rows(chunk, doc_ids, found)
                    chunk, doc_ids, found, size = chunk + 1, [], [], 0
        if found:
            yield from chunk_rows(chunk, doc_ids, found)

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Chunks are told by numbers that only hold as written, so the rows are stored.
    return common.stored(plain.mapInArrow(aligned, ALIGNED_DDL), "alignment", compression="zstd")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A's id times 2**32 plus B's) and the documents that hold it."""
    held = aligned.filter("pairs is not null").select(F.inline(F.arrays_zip("pairs", "holders")))
    return held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n"))


def measured(aligned: DataFrame) -> DataFrame:
    """Every document's numbers, among them ``n_best`` and ``count_sum`` by the counts of its links."""
    counts = common.stored(pair_counts(aligned), "alignment-counts")
    id_a = F.shiftright("pair", 32)
    # One row per id of A's vocabulary at most, so it may be sent to all.
    best = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("most"))
    asked = aligned.filter("pairs is not null").select("chunk", F.posexplode("pairs").alias("place", "asked"))
    told = (
        asked.join(counts, F.col("asked") == F.col("pair"))
        .join(F.broadcast(best), id_a == F.col("a"))
        .select(F.col("chunk").alias("of"), "place", "n", (F.col("n") == F.col("most")).alias("is_best"))
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    schema = ", ".join(f"{name} bigint" for name in [*names, "n_best", "count_sum"]) + ", groups_sha256 string"

    def add_up(documents: pa.Table, answers: pa.Table) -> pa.Table:
        counts, best = np.zeros(len(answers), np.int64), np.zeros(len(answers), np.int64)
        place = answers["place"].to_numpy()
        counts[place], best[place] = answers["n"].to_numpy(), answers["is_best"].to_numpy()
        places, times = documents["places"].combine_chunks(), documents["times"].combine_chunks()
        at, often = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        lengths = places.value_lengths().to_numpy()
        stops = np.cumsum(lengths)

        def per_document(values: np.ndarray) -> np.ndarray:
            summed = np.concatenate([[0], np.cumsum(values)])
            return summed[stops] - summed[stops - lengths]

        return pa.table(
            {name: documents[name] for name in names}
            | {"n_best": per_document(best[at] * often), "count_sum": per_document(counts[at] * often)}
            | {"groups_sha256": documents["groups_sha256"]}
        )

    rows = aligned.filter("pairs is null").drop("pairs", "holders")
    return rows.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(add_up, schema)
