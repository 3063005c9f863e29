"""Token ids as flat binary files with 64-bit document offsets, read by memory map.

Documents are dealt into ranges of ascending doc_id and encoded; every task
writes one shard, as it reads its sorted rows, so no shard is held in memory:

- ``.bin``: ids as unsigned little-endian integers, 16 bits where the vocabulary
  allows it, else 32; each document is followed by the end id;
- ``.idx``: 64-bit offsets, in ids, of the documents, and the end of the last;
- ``.doc``: 64-bit doc_ids, where the first ``n_null`` documents have none.

A shard counts only if the manifest, a table of one row per shard, names it; a
task that is run again writes files of another name, so a lost executor leaves
no half-written shard in the manifest.  The base of a shard is the sum of the
ids in the shards before it.

Null and empty texts are the end id alone.  Rows without a doc_id come first;
rows of one doc_id are ordered by a digest of their text, repeated rows are
written one by one, further columns are left out, and an empty table makes no
shard.  Texts of any length are encoded whole, in slices that no token crosses
(see :mod:`units`), so a long text is not held as one list of ids; only a text
of many MB without white space is given to the tokenizer at once.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, units

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Units of a generation that a worker remembers.
KEPT = 800_000
#: Documents that one task reads back at once.
READ_DOCS = 20_000

MANIFEST = "part int, path string, n_docs bigint, n_ids bigint, n_null bigint, width int"
WRITTEN = pa.schema(
    [
        ("part", pa.int32()),
        ("path", pa.string()),
        ("n_docs", pa.int64()),
        ("n_ids", pa.int64()),
        ("n_null", pa.int64()),
        ("width", pa.int32()),
    ]
)
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def place(path: str):
    """File system and path of a folder or file, which may be local, mounted or in a store pyarrow knows."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class Encoder:
    """Ids of texts as bytes of the file; units that came before are not encoded again."""

    def __init__(self, tokenizer_json: str) -> None:
        self.byte_level = units.ByteLevel(tokenizer_json)
        self.tokenizer = self.byte_level.tokenizer
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.memory = units.Memory(KEPT)

    def _learn(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of new units, which are encoded at once."""
        new, ids, stops = self.byte_level.encode(new)
        packed, stops = ids.astype(self.dtype).tobytes(), (stops * self.dtype.itemsize).tolist()
        return zip(new, map(packed.__getitem__, map(slice, [0, *stops], stops)))

    def encode(self, text: str) -> Iterator[bytes]:
        for found in units.slices(text, self.byte_level.cut):
            yield b"".join(self.memory.values(found, self._learn))

    def encode_run(self, texts: list[str]) -> list[list[bytes]]:
        """Parts of each of some texts; one text alone may be long, and is encoded in slices."""
        if len(texts) == 1:
            return [[*self.encode(texts[0])]]
        cut = [[*chain.from_iterable(units.slices(text, self.byte_level.cut))] for text in texts]
        values = self.memory.values([*chain.from_iterable(cut)], self._learn)
        return [[one] for one in units.joined(values, cut)]


@lru_cache(maxsize=1)
def encoder_of(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


class ShardWriter:
    """Appends documents to the three files of a shard."""

    def __init__(self, path: str, dtype: np.dtype) -> None:
        system, local = place(path)
        system.create_dir(local.rsplit("/", 1)[0], recursive=True)
        self.ids, self.offsets, self.docs = (system.open_output_stream(f"{local}.{kind}") for kind in ("bin", "idx", "doc"))
        self.width = dtype.itemsize
        self.n_docs = self.n_ids = self.n_null = 0
        self.offsets.write(np.int64(0).astype("<i8").tobytes())

    def add(self, doc_ids: list[int | None], parts: list[list[bytes]]) -> None:
        lengths = np.array([sum(map(len, one)) // self.width for one in parts], np.int64)
        self.ids.write(b"".join(b"".join(one) for one in parts))
        self.offsets.write((self.n_ids + np.cumsum(lengths)).astype("<i8").tobytes())
        self.docs.write(np.array([one or 0 for one in doc_ids], "<i8").tobytes())
        self.n_docs += len(parts)
        self.n_ids += int(lengths.sum())
        self.n_null += sum(one is None for one in doc_ids)

    def close(self) -> None:
        for stream in (self.ids, self.offsets, self.docs):
            stream.close()


class Shard:
    """A written shard: memory maps where the files are local or mounted, else range reads."""

    def __init__(self, path: str, width: int) -> None:
        self.system, self.path = place(path)
        self.dtype = np.dtype(f"<u{width}")

    def read(self, kind: str, dtype, start: int, stop: int) -> np.ndarray:
        from pyarrow import fs

        dtype = np.dtype(dtype)
        if start >= stop:
            return np.empty(0, dtype)
        if isinstance(self.system, fs.LocalFileSystem):
            return np.memmap(f"{self.path}.{kind}", dtype, "r")[start:stop]
        with self.system.open_input_file(f"{self.path}.{kind}") as file:
            return np.frombuffer(file.read_at((stop - start) * dtype.itemsize, start * dtype.itemsize), dtype)

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Where documents ``first`` to ``last - 1`` begin, and where the last of them ends."""
        return self.read("idx", "<i8", first, last + 1)

    def doc_ids(self, first: int, last: int) -> np.ndarray:
        return self.read("doc", "<i8", first, last)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return self.read("bin", self.dtype, start, stop)


def write(documents: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write every text's ids below ``folder``, which all executors see; return the stored manifest."""
    with open(tokenizer, encoding="utf-8") as file:
        tokenizer_json = file.read()

    def shard(batches):
        encoder, writer, path = encoder_of(tokenizer_json), None, ""
        end = np.array([end_id], encoder.dtype).tobytes()
        part = TaskContext.get().partitionId()
        for batch in batches:
            if writer is None:
                path = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex[:8]}"
                writer = ShardWriter(path, encoder.dtype)
            doc_ids = iter(batch["doc_id"].to_pylist())
            for texts in units.runs(text.as_py() or "" for text in batch["text"]):
                parts = [[*one, end] for one in encoder.encode_run(texts)]
                writer.add([*islice(doc_ids, len(parts))], parts)
        if writer is not None:
            writer.close()
            row = [part, path, writer.n_docs, writer.n_ids, writer.n_null, writer.width]
            yield pa.RecordBatch.from_pylist([dict(zip(WRITTEN.names, row))], schema=WRITTEN)

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    return common.stored(ranges.mapInArrow(shard, MANIFEST), "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the ids in all shards before; it has one row per shard."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, number and checksum of the ids of every document, from the files that ``manifest`` names."""

    def digests(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"], row["width"])
                first, last = row["first"], min(row["first"] + READ_DOCS, row["n_docs"])
                offsets = shard.offsets(first, last)
                starts, lengths = np.array(offsets[:-1]), np.diff(offsets)
                ids = shard.ids(int(offsets[0]), int(offsets[-1]))
                crcs = [
                    zlib.crc32(ids[at : at + n].astype("<u4"))
                    for at, n in zip((starts - offsets[0]).tolist(), lengths.tolist())
                ]
                missing = np.arange(first, last) < row["n_null"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(shard.doc_ids(first, last)), mask=missing),
                        pa.array(row["base"] + starts),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema=READ,
                )

    firsts = F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(READ_DOCS).cast("long"))
    pieces = with_bases(manifest).withColumn("first", F.explode(firsts))
    # As many tasks as pieces: their rows are small, what they stand for is not.
    count = manifest.agg(F.sum(F.ceil(F.col("n_docs") / READ_DOCS))).first()[0] or 1
    dealt = pieces.repartition(int(count), "part", "first")
    return dealt.mapInArrow(digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
