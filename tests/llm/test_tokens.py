"""Token files and alignment against plain versions over whole texts."""

from __future__ import annotations

import hashlib
import random
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest
from corpora import documents, odd_rows

from forgelens.llm import alignment, queries, token_files, units
from forgelens.llm.common import scratch_dir

ALPHABET = [*"ab1'!s \n\t\r\x0b\x1c\x85\xa0 　é漢\x00▁<>", "<|endoftext|>", "'s", "  ", "\r\n", "<s>", "<0x41>", "hello", " world"]


def nasty(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    return (
        Tokenizer.from_file(token_files.TOKENIZER),
        sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE),
    )


def whole_ids(tokenizer, text, plain=False):
    tokenizer.encode_special_tokens = plain
    return tokenizer.encode(text, add_special_tokens=False).ids


def key(row):
    return tuple((value is None, value) for value in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# Units


def test_units_of_a_text_are_encoded_as_the_text_is(library, monkeypatch):
    monkeypatch.setattr(units, "SLICE", 5)
    for text in nasty(1, 3000):
        found = [unit for part in units.slices(text) for unit in part]
        assert "".join(found) == text
        assert [i for unit in found for i in whole_ids(library[0], unit)] == whole_ids(library[0], text)


def test_tokenizers_that_do_not_split_at_blanks_get_whole_texts():
    split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    token = {"lstrip": False, "rstrip": False, "single_word": False, "content": "<e>"}
    assert units.fits({"pre_tokenizer": split, "added_tokens": [token]})
    for other in (
        {"pre_tokenizer": split | {"use_regex": False}},
        {"pre_tokenizer": split | {"add_prefix_space": True}},
        {"pre_tokenizer": split, "normalizer": {"type": "NFC"}},
        {"pre_tokenizer": split, "added_tokens": [token | {"content": "a b"}]},
        {"pre_tokenizer": split, "added_tokens": [token | {"lstrip": True}]},
        {"pre_tokenizer": None},
    ):
        assert not units.fits(other)
    assert list(units.slices("a b", cut=False)) == [["a b"]] and list(units.slices("", cut=False)) == [[]]


# Token files


def plain_files(tokenizer, rows):
    """Rows (doc_id, text) as op12 has them, from whole texts."""
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    out, start = [], 0
    for doc_id, text in ordered:
        ids = [*whole_ids(tokenizer, text or ""), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def op12(spark, frame, **options):
    return token_files.read(token_files.write(frame, scratch_dir(spark, "files"), **options))


def test_files_hold_what_the_library_encodes(spark, library):
    rows = [(i * 7 % 501, text) for i, text in enumerate(nasty(2, 500))]
    got = op12(spark, documents(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    # Ids that differ have one order; of equal ids the digest of the text decides.
    assert len({i for i, _ in rows}) == 500
    same(got, plain_files(library[0], rows))


def test_odd_rows_and_extra_columns_are_written(spark, odd, library):
    got = op12(spark, odd).collect()
    assert len(got) == len(odd_rows())
    want = Counter((i, n, crc) for i, _, n, crc in plain_files(library[0], [row[:2] for row in odd_rows()]))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    starts = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert [s for s, _, _ in starts] == [0, *np.cumsum([n for _, n, _ in starts])[:-1]]
    ids = [i for _, _, i in starts]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty_table_writes_no_shard(spark, empty):
    assert op12(spark, empty).collect() == []


def test_shards_are_flat_and_mapped(spark, library):
    texts = ["one two", "", None, "three"]
    manifest = token_files.write(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), scratch_dir(spark, "f"))
    ids = []
    for row in manifest.orderBy("part").collect():
        shard = token_files.Shard(row.path, row.width)
        offsets = shard.offsets(0, row.n_docs)
        assert offsets.dtype == np.dtype("<i8") and offsets[0] == 0 and offsets[-1] == row.n_ids
        found = shard.ids(0, row.n_ids)
        assert isinstance(found, np.memmap) and found.dtype == np.dtype("<u2")
        ids += found.tolist()
    assert ids == [i for text in texts for i in [*whole_ids(library[0], text or ""), 0]]


def test_a_large_vocabulary_takes_32_bits(library):
    encoder = token_files.Encoder(library[0].to_str())
    assert encoder.dtype.itemsize == 2
    encoder.tokenizer.add_tokens([f"<extra{i}>" for i in range(20_000)])
    assert token_files.Encoder(encoder.tokenizer.to_str()).dtype.itemsize == 4


def test_starts_follow_over_many_shards(spark, library):
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(300)]
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        manifest = token_files.write(frame, scratch_dir(spark, "shards"))
        assert manifest.count() > 1
        same(token_files.read(manifest).collect(), plain_files(library[0], rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# Alignment


def plain_alignment(library, rows):
    """The contract over whole texts, from the byte range of every token."""
    tokenizer, pieces = library
    names = {i: token for token, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    alphabet = alignment.byte_alphabet()
    found = []
    for doc_id, text in rows:
        a = whole_ids(tokenizer, " " + text, plain=True) if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in names[i]) for i in a]
        bytes_b = [alignment.piece_bytes(pieces.id_to_piece(i)) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            stops = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip([0, *stops[:-1]], stops)))
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        stops = [[e for _, e in one] for one in spans]
        linked = []
        for i, (s, e) in enumerate(spans[0]):
            k = bisect_right(stops[1], s)
            while k < len(b) and spans[1][k][0] < e:
                linked.append((a[i], b[k]))
                k += 1
        cut = [0, *shared]
        inside = [[ids[bisect_right(stop, lo) : bisect_right(stop, hi)] for lo, hi in zip(cut, cut[1:])] for ids, stop in zip((a, b), stops)]
        texts = ["|".join(",".join(map(str, ids)) for ids in pair) for pair in zip(*inside)]
        found.append((doc_id, a, b, texts, linked))
    count = Counter(pair for *_, linked in found for pair in set(linked))
    best: dict[int, int] = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (
            doc_id, len(a), len(b), len(texts), len(linked),
            sum(count[pair] == best[pair[0]] for pair in linked), sum(count[pair] for pair in linked),
            hashlib.sha256(";".join(texts).encode()).hexdigest() if a else "",
        )
        for doc_id, a, b, texts, linked in found
    ]


def op13(frame):
    return alignment.measured(alignment.align(frame)).collect()


def test_alignment_equals_whole_texts(spark, library):
    rows = list(enumerate(nasty(3, 300)))
    same(op13(documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(5)), plain_alignment(library, rows))


def test_alignment_over_slices(library, monkeypatch):
    monkeypatch.setattr(units, "SLICE", 3)
    with open(alignment.BYTE_BPE, encoding="utf-8") as a, open(alignment.PIECE_BPE, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    rows = list(enumerate(nasty(4, 300)))
    want = plain_alignment(library, rows)
    for (_, text), (_, n_a, n_b, n_groups, n_links, _, _, digest) in zip(rows, want):
        pairs, times, numbers, found = aligner.document(text)
        assert (numbers, int(times.sum()), found) == ([n_a, n_b, n_groups], n_links, digest)
        assert len(set(pairs.tolist())) == len(pairs)


def test_alignment_of_odd_rows(spark, odd, library):
    same(op13(odd), plain_alignment(library, [row[:2] for row in odd_rows()]))


def test_alignment_of_an_empty_table(spark, empty):
    assert op13(empty) == []


def test_documents_over_several_chunks_share_their_counts(spark, library):
    rows = [(i, f"shared words and word{i % 5} {'x' * (i % 7)}") for i in range(60)]
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(9)
    aligned = alignment.align(frame)
    assert aligned.select("chunk").distinct().count() > 1
    same(alignment.measured(aligned).collect(), plain_alignment(library, rows))


def test_groups_and_links_of_given_ends():
    assert [stops.tolist() for stops in alignment.groups([2, 3, 6], [3, 4, 6])] == [[2, 3], [1, 3]]
    places = alignment.links(np.array([2, 4, 6]), np.array([3, 6]))[:2]
    assert list(zip(*(p.tolist() for p in places))) == [(0, 0), (1, 0), (1, 1), (2, 1)]


def test_units_that_come_again_outlive_a_generation():
    memory = units.Memory(kept=2)
    for found in (["a", "b", "c"], ["a", "d"], ["e", "f"]):
        new = memory.missing(found)
        memory.known.update((unit, unit) for unit in new)
        assert all(unit in memory.known for unit in found)
    assert memory.missing(["a"]) == [] and memory.missing(["b"]) == ["b"]


def test_models_that_do_not_split_at_words_align_whole_texts(library, monkeypatch):
    with open(alignment.BYTE_BPE, encoding="utf-8") as a, open(alignment.PIECE_BPE, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = nasty(6, 200)
    want = [aligner.document(text)[2:] for text in texts]
    aligner.cut = False
    assert [aligner.document(text)[2:] for text in texts] == want


@pytest.mark.parametrize("name, plain", [("op12_token_files", plain_files), ("op13_alignment", plain_alignment)])
def test_query_over_the_whole_table(spark, library, name, plain):
    path = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    same(queries.queries()[name](spark, path).collect(), plain(library if name.startswith("op13") else library[0], rows))


def test_units_in_a_row_keep_their_ids(library):
    coder = units.ByteLevel(library[0].to_str())
    new = sorted({unit for text in nasty(7, 300) for part in units.slices(text) for unit in part} | {" ", "\n ", "a\u3000"})
    calls, ids_of = [], coder._ids
    coder._ids = lambda texts: calls.append(len(texts)) or ids_of(texts)
    order, ids, stops = coder.encode(new)
    assert sorted(order) == new and len(calls) == 1 and calls[0] < len(new)
    found = [part.tolist() for part in np.split(ids, stops[:-1])]
    assert found == [one.ids for one in coder.tokenizer.encode_batch_fast(order, add_special_tokens=False)]


def test_texts_of_a_run_are_encoded_and_aligned_at_once(library):
    texts = [*nasty(8, 100), "", "a \u2581 b", "last  one\n"]
    encoder = token_files.Encoder(library[0].to_str())
    calls, encode = [], encoder.byte_level.encode
    encoder.byte_level.encode = lambda new: calls.append(new) or encode(new)
    found = [np.frombuffer(b"".join(parts), encoder.dtype).tolist() for parts in encoder.encode_run(texts)]
    assert len(calls) == 1
    assert found == [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    with open(alignment.BYTE_BPE, encoding="utf-8") as a, open(alignment.PIECE_BPE, "rb") as b:
        proto, tokenizer_json = b.read(), a.read()
    together, alone = (alignment.Aligner(tokenizer_json, proto) for _ in range(2))
    for one, other in zip(together.documents(texts), map(alone.document, texts), strict=True):
        assert one[2:] == other[2:] and all(map(np.array_equal, one[:2], other[:2]))


def test_runs_of_texts_keep_all_of_them_in_order():
    texts = ["ab", "", "c", "long text", "d", "ef"]
    assert [*units.runs(texts, 3)] == [["ab", "", "c"], ["long text"], ["d", "ef"]] and [*units.runs([])] == []


def test_sure_units_are_split_as_the_tokenizer_splits_them(library):
    rng = random.Random(9)
    signs = [*"abZ09_.,-!?\"#$|<>()[]{}~^`é", "ß", "ɏ", "Ωσ", "Жя", "word", "<|endoftext|>"]
    sure = {rng.choice(" \n") + "".join(rng.choices(signs, k=rng.randrange(1, 9))) for _ in range(3000)}
    others = {" it's", " 'tis", "  two", "\n\nline", " λόγος", " 漢字", " á", "start", " "}
    coder = units.ByteLevel(library[0].to_str())
    library[0].encode_special_tokens = False
    given, ids_of = [], coder._ids
    coder._ids = lambda texts: given.extend(texts) or ids_of(texts)
    order, ids, stops = coder.encode([*sure, *others])
    assert {*order} == sure | others and len(order) == len(stops)
    for unit, part in zip(order, np.split(ids, stops[:-1]), strict=True):
        assert part.tolist() == library[0].encode(unit, add_special_tokens=False).ids
    # Only the others and what holds a special token are left to the whole tokenizer.
    assert sum(map(len, given)) == sum(map(len, others)) + sum(len(unit) for unit in sure if "<|endoftext|>" in unit)
    assert coder.encode([])[0] == []


def test_units_are_looked_up_once_and_learned_in_any_order():
    memory, learned = units.Memory(kept=3), []

    def learn(new):
        learned.append(sorted(new))
        return ((unit, unit.upper()) for unit in reversed(new))

    long = "x" * (units.LONGEST_KEPT + 1)
    for found in (["a", "b", "a", long], ["b", "c", "d"], ["a", "e", long], []):
        assert memory.values(found, learn) == [unit.upper() for unit in found]
    assert learned == [["a", "b", long], ["c", "d"], ["e", long]]
    assert units.joined([b"1", b"2", b"3"], [["a"], [], ["b", "c"]]) == [b"1", b"", b"23"]
