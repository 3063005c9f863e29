"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model's protobuf is parsed here, and normaliser, metaspace marker, unigram
scores or merges, and byte fallback are rebuilt from it.  Batches are encoded
by several threads, and all ids are held against SentencePiece's own.

Where the vocabulary shows that no piece can cross the border of a word, a task
encodes and decodes each unit of the texts (:mod:`units`) once, the new ones of
many texts together, and keeps the last ones; a text's ids are then those of its
units in a row, and are still held against the ids that SentencePiece gives for
the whole text.  Other models take
whole texts throughout.

A null text has null ids and 0 tokens; an empty text has no ids.  Repeated rows
are encoded one by one, texts of any length as a whole, and further columns are
left out.  The text is given back by decoding, but for what the model itself
does not keep: a literal U+2581 becomes a blank, and a model that folds
characters or blanks gives back folded text.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Bytes of text that are encoded at once, beside a text that is longer by itself.
CHUNK_BYTES = 2 << 20

MARK = "▁"

# Numbers of the protobuf's fields and enumerations.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, BYTE_FALLBACK, UNKNOWN_ID = 3, 35, 40
CHARS_MAP, DUMMY_PREFIX, REMOVE_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a protobuf message: ints, four or eight raw bytes, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        length = {1: 8, 5: 4}.get(wire) or varint()
        yield tag >> 3, data[at : at + length]
        at += length


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    type: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    chars_map: bytes = b""
    dummy_prefix: bool = True
    remove_blanks: bool = True
    escape_blanks: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in fields(data):
            if number == PIECES:
                piece = {SCORE: b"\0\0\0\0", KIND: NORMAL} | dict(fields(value))
                model.pieces.append(piece.get(PIECE, b"").decode())
                model.scores.append(struct.unpack("<f", piece[SCORE])[0])
                model.kinds.append(piece[KIND])
            elif number == TRAINER:
                known = dict(fields(value))
                model.type = known.get(MODEL_TYPE, model.type)
                model.byte_fallback = bool(known.get(BYTE_FALLBACK, False))
                model.unknown = known.get(UNKNOWN_ID, 0)
            elif number == NORMALIZER:
                known = dict(fields(value))
                model.chars_map = known.get(CHARS_MAP, b"")
                model.dummy_prefix = bool(known.get(DUMMY_PREFIX, True))
                model.remove_blanks = bool(known.get(REMOVE_BLANKS, True))
                model.escape_blanks = bool(known.get(ESCAPE_BLANKS, True))
        if model.type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model.type} is neither unigram nor BPE")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best piece first."""
        # Bytes and control pieces are never made by merging.
        ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER_DEFINED, UNUSED)}
        found = []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in ids and right in ids:
                    found.append((-self.scores[i], ids[left], ids[right], left, right))
        return [(left, right) for *_, left, right in sorted(found)]

    def splits_at_words(self) -> bool:
        """Whether pieces stay within words, and texts reach the model as they are.

        That is so if no piece has a marker after another character, none has a
        line end, and the normaliser does no more than write blanks as markers.
        """
        crossing = any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in self.pieces)
        return self.escape_blanks and not (crossing or self.chars_map or self.remove_blanks)


def rebuild(model: Model, prefix: bool = True):
    """A tokenizer of the tokenizers library with the model's parts; ``prefix``: of whole texts."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    unknown = model.pieces[model.unknown]
    if model.type == UNIGRAM:
        vocabulary = list(zip(model.pieces, model.scores))
        tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=model.unknown, byte_fallback=model.byte_fallback))
    else:
        vocabulary = {piece: i for i, piece in enumerate(model.pieces)}
        tokenizer = Tokenizer(
            models.BPE(vocabulary, model.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
        )
    steps = []
    if model.chars_map:
        steps.append(normalizers.Precompiled(model.chars_map))
    if model.remove_blanks:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_blanks:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix and prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    special = [AddedToken(p, normalized=False) for p, k in zip(model.pieces, model.kinds) if k == USER_DEFINED]
    if special:
        tokenizer.add_tokens(special)
    return tokenizer


class Codec:
    """Encodes and decodes whole texts with the rebuilt tokenizer, and has SentencePiece's own ids."""

    def __init__(self, proto: bytes, threads: int = THREADS):
        # The library reads these when its threads start.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        self.threads = threads
        self.model = Model.parse(proto)
        self.tokenizer = rebuild(self.model)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=proto)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def reference(self, texts: list[str]) -> list[bytes]:
        """SentencePiece's ids as 32-bit numbers."""
        found = self.original.encode(texts, out_type="numpy", num_threads=self.threads) if texts else []
        return [ids.astype("<i4", copy=False).tobytes() for ids in found]

    def checked(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[bool]]:
        """Ids as 32-bit numbers, parity and round trip of whole texts."""
        ids = self.encode(texts)
        same = [a == b for a, b in zip(texts, self.decode(ids))]
        packed = [np.array(one, dtype="<i4").tobytes() for one in ids]
        return packed, [a == b for a, b in zip(packed, self.reference(texts))], same


class UnitCodec(Codec):
    """The same for models whose pieces stay within words: each unit of the texts is encoded once.

    Parity is still that of the whole text, which SentencePiece encodes itself,
    a long one in slices that begin with the blank it would put there.
    """

    def __init__(self, proto: bytes, threads: int = THREADS):
        super().__init__(proto, threads)
        self.unit_tokenizer = rebuild(self.model, prefix=False)
        self.prefix = " " if self.model.dummy_prefix else ""
        self.alone = struct.pack("<i", self.original.piece_to_id(MARK))
        # Pieces that are found before the model splits a text.
        self.added = USER_DEFINED in self.model.kinds
        self.memory = units.Memory()
        #: Known units that are not given back.
        self.changed: set[str] = set()

    def reference(self, texts: list[str]) -> list[bytes]:
        """SentencePiece's ids of slices that have their first blank already."""
        if not self.prefix:
            return super().reference(texts)
        found = super().reference([text[1:] for text in texts])
        # A single blank leaves an empty text, which has no ids of its own.
        return [self.alone if text == " " else ids for text, ids in zip(texts, found)]

    def slices(self, text: str) -> Iterator[list[str]]:
        """Units in runs that begin with a blank, if the model puts one before texts."""
        held: list[str] = []
        for found in units.slices(self.prefix + text if text else ""):
            if held and found[0].startswith(" "):
                yield held
                held = []
            held += found
        if held:
            yield held

    def _unit_ids(self, new: list[str]) -> list[list[int]]:
        if self.added:
            return [one.ids for one in self.unit_tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        tokenize = self.unit_tokenizer.model.tokenize
        return [[token.id for token in tokenize(unit.replace(" ", MARK))] for unit in new]

    def _learn(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of new units, which are decoded at once, and one by one if they do not all come back."""
        ids = self._unit_ids(new)
        row = [*chain.from_iterable(ids)]
        # Unknown pieces may change the length; all else that is changed stays in its place.
        if self.model.unknown in row or self.unit_tokenizer.decode(row, skip_special_tokens=False) != "".join(new):
            if len(self.changed) > self.memory.kept:
                self.changed = {u for u in self.changed if u in self.memory.known or u in self.memory.older}
            back = self.unit_tokenizer.decode_batch(ids, skip_special_tokens=False)
            self.changed.update(unit for unit, other in zip(new, back) if unit != other)
        return zip(new, [array("i", one).tobytes() for one in ids])

    def checked(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[bool]]:
        parts: list[list[bytes]] = [[] for _ in texts]
        parity, same, held, size = [True] * len(texts), [True] * len(texts), [], 0

        def compare() -> None:
            places, cut, whole = zip(*held)
            own = units.joined(self.memory.values([*chain.from_iterable(cut)], self._learn), cut)
            for place, found, ids, reference in zip(places, cut, own, self.reference(whole), strict=True):
                parts[place].append(ids)
                parity[place] = parity[place] and ids == reference
                same[place] = same[place] and self.changed.isdisjoint(found if self.changed else ())
            held.clear()

        for place, text in enumerate(texts):
            for found in self.slices(text):
                held.append((place, found, "".join(found)))
                size += len(held[-1][2])
                if size > units.SLICE >> 1:
                    compare()
                    size = 0
        if held:
            compare()
        return [b"".join(one) for one in parts], parity, same


@lru_cache(maxsize=1)
def codec_of(proto: bytes, threads: int = THREADS) -> Codec:
    """The codec of this Python worker, which keeps its words from task to task."""
    return (UnitCodec if Model.parse(proto).splits_at_words() else Codec)(proto, threads)


def chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Runs of texts that hold ``most`` characters, or one longer text."""
    start = held = 0
    for place, text in enumerate(texts):
        length = len(text or "")
        if held and held + length > most:
            yield slice(start, place)
            start, held = place, 0
        held += length
    if start < len(texts):
        yield slice(start, len(texts))


ENCODED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
        ("parity", pa.bool_()),
        ("round_trip", pa.bool_()),
    ]
)
SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, parity boolean, round_trip boolean"


def encode(documents: DataFrame, model: str = MODEL, threads: int = THREADS) -> DataFrame:
    """Ids of every whole text, whether they equal SentencePiece's, and whether they decode to the text.

    The model file is read on the driver and travels with the task.
    """
    with open(model, "rb") as file:
        proto = file.read()

    def encoded(batches):
        codec = codec_of(proto, threads)
        for batch in batches:
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for part in chunks(texts):
                ids, parity, same = codec.checked([text or "" for text in texts[part]])
                lengths = np.array([len(one) // 4 for one in ids], dtype=np.int64)
                starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                missing = np.array([*[text is None for text in texts[part]], False])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids[part], pa.int64()),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(
                            pa.array(starts, mask=missing), pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                        ),
                        pa.array(parity, pa.bool_()),
                        pa.array(same, pa.bool_()),
                    ],
                    schema=ENCODED,
                )

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(encoded, SCHEMA)


def decode(encoded: DataFrame, model: str = MODEL, threads: int = THREADS) -> DataFrame:
    """Texts of ``encoded`` (doc_id, ids); null ids give a null text."""
    with open(model, "rb") as file:
        proto = file.read()

    def decoded(batches):
        codec = Codec(proto, threads)
        for batch in batches:
            ids = batch["ids"].to_pylist()
            texts = codec.decode([one or [] for one in ids])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([None if one is None else t for one, t in zip(ids, texts)], pa.string())],
                names=["doc_id", "text"],
            )

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        decoded, "doc_id bigint, text string"
    )


