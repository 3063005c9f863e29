"""Sharding, SentencePiece, license scans, quality ranking and neighbour search."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest
import sentencepiece
from corpora import documents, odd_rows, random_texts
from pyspark.sql import functions as F

from forgelens.llm import ann, license_scan, pieces, quality_rank, sharding


def test_shards_are_decided_by_key_and_grow_into_the_new_one(spark):
    rows = [(i, f"text {i % 7}", "en", "s") for i in range(2000)]
    docs = documents(spark, rows)
    found = {r["row"]["doc_id"]: r for r in sharding.sharded(docs, shards=5, bucket_bytes=1000).collect()}
    again = {r["row"]["doc_id"]: r for r in sharding.sharded(docs.orderBy(F.desc("doc_id")), shards=5, bucket_bytes=1000).collect()}
    more = {r["row"]["doc_id"]: r for r in sharding.external_shuffle(docs, shards=6).collect()}
    assert len(found) == 2000 and found == again
    for shard in range(5):
        slots = sorted(r["slot"] for r in found.values() if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 300 < len(slots) < 500
    for i, row in found.items():
        assert row["grown_shard"] == more[i]["shard"] and row["grown_shard"] in (row["shard"], 5)


def test_fisher_yates_gives_all_orders_alike():
    rng = np.random.default_rng(1)
    seen = [tuple(sharding.fisher_yates(3, rng)) for _ in range(6000)]
    assert len(set(seen)) == 6 and all(850 < seen.count(order) < 1150 for order in set(seen))
    assert list(sharding.fisher_yates(0, rng)) == [] and list(sharding.fisher_yates(1, rng)) == [0]


def test_sharding_takes_odd_rows(odd, empty):
    found = sharding.sharded(odd)
    assert found.count() == odd.count() and found.select("row.*").exceptAll(odd).isEmpty()
    assert found.filter("row.doc_id is null").select("shard").distinct().count() == 1
    assert sharding.sharded(empty).count() == 0


@pytest.fixture(scope="module")
def proto():
    with open(pieces.MODEL, "rb") as file:
        return file.read()


def test_ids_equal_those_of_the_original(proto):
    texts = [t or "" for _, t, _, _ in odd_rows()] + random_texts(1, 60)
    texts += ["  two  blanks ", "\n", " \n ", "a\nb", "<s> </s> <unk> <0x41>", "日本語のテキスト", "x" * 5000, "½²."]
    original = sentencepiece.SentencePieceProcessor(model_proto=proto)
    want = original.encode(texts)
    for codec in (pieces.Codec(proto, 1), pieces.UnitCodec(proto, 1)):
        ids, parity, same = codec.checked(texts)
        assert [np.frombuffer(one, "<i4").tolist() for one in ids] == want
        assert all(parity) and [t for t, s in zip(texts, same) if not s] == [t for t in texts if pieces.MARK in t]
    assert pieces.Codec(proto, 1).decode(want) == [original.decode(one) for one in want]


class Counted:
    """A tokenizer whose calls are counted."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, []

    def __getattr__(self, name):
        self.calls.append(name)
        return getattr(self.tokenizer, name)


def test_units_of_many_texts_are_learned_at_once(proto, monkeypatch):
    texts = [*filter(None, random_texts(3, 40)), "", "it's  two\nlines", " ", "x" * 70]
    original = sentencepiece.SentencePieceProcessor(model_proto=proto)
    codec = pieces.UnitCodec(proto, 1)
    codec.unit_tokenizer = Counted(codec.unit_tokenizer)
    plain = [text for text in texts if pieces.MARK not in text]
    ids, parity, same = codec.checked(plain)
    assert [np.frombuffer(one, "<i4").tolist() for one in ids] == original.encode(plain) and all(parity) and all(same)
    assert codec.unit_tokenizer.calls == ["model", "decode"] and not codec.changed
    # What is not given back is told of every text that has it, also when its unit is known.
    marked = ["a \u2581 b", "plain", "c a \u2581 b", ""]
    for _ in range(2):
        assert codec.checked(marked)[1:] == ([True] * 4, [False, True, False, True])
    monkeypatch.setattr(pieces.units, "SLICE", 4)
    assert codec.checked(marked)[1:] == ([True] * 4, [False, True, False, True])
    # Ids that are not SentencePiece's are told as well.
    monkeypatch.setitem(codec.memory.known, " plain", b"\0\0\0\0")
    assert codec.checked(marked)[1] == [True, False, True, True]


def message(*parts: tuple[int, object]) -> bytes:
    """A protobuf message of numbers, floats and bytes."""
    out = b""
    for number, value in parts:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            data = value.encode() if isinstance(value, str) else value
            wire = 0 if isinstance(value, int) else 2
            tag, rest = number << 3 | wire, value if isinstance(value, int) else len(data)
            for n in (tag, rest):
                while n > 127:
                    out += bytes([n & 127 | 128])
                    n >>= 7
                out += bytes([n])
            out += data if wire else b""
    return out


@pytest.mark.parametrize("remove_blanks", [0, 1])
def test_a_unigram_model_is_rebuilt_from_its_protobuf(remove_blanks):
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    listed += [("▁", -3.0, 1), ("▁the", -2.0, 1), ("▁a", -2.5, 1), ("he", -4.0, 1), ("t", -5.0, 1), ("h", -5.5, 1), ("e", -5.2, 1)]
    proto = b"".join(message((1, message((1, p), (2, s), (3, k)))) for p, s, k in listed)
    proto += message((2, message((3, 1), (35, 1), (40, 0)))) + message((3, message((1, "identity"), (3, 1), (4, remove_blanks), (5, 1))))
    original = sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts = ["the  a the", "thé", "  heh ", "", "a\nthe"]
    codec = pieces.codec_of(proto, 1)
    assert isinstance(codec, pieces.UnitCodec) != bool(remove_blanks)
    ids, parity, _ = codec.checked(texts)
    assert [np.frombuffer(one, "<i4").tolist() for one in ids] == original.encode(texts) and all(parity)


def test_encoding_takes_odd_rows_and_comes_back(odd, empty):
    found = pieces.encode(odd)
    rows = found.collect()
    assert len(rows) == odd.count() and all(r["parity"] for r in rows)
    assert {(r["doc_id"], r["text"]) for r in pieces.decode(found).collect() if r["doc_id"] != 8} == {
        (i, t) for i, t, _, _ in odd_rows() if i != 8
    }
    assert next(r for r in rows if r["doc_id"] == 1)["ids"] is None
    assert next(r for r in rows if r["doc_id"] == 2)["ids"] == []
    assert pieces.encode(empty).count() == 0


TEMPLATE = 'Start <<beginOptional>>very <<beginOptional>>much<<endOptional>> so<<endOptional>> by <<var;name="x";words=2>> end'


@pytest.mark.parametrize(
    ("text", "accepted"),
    [
        ("start by end", True),
        ("START very so by me, end.", True),
        ("start very much so by me you end", True),
        ("start very by end", False),
        ("start by one two three end", False),
        ("start so by end", False),
        ("begin by end", False),
        ("start by", False),
    ],
)
def test_templates_accept_what_their_markup_allows(text, accepted):
    import re

    automaton = license_scan.compile_template(TEMPLATE)
    words = license_scan.words_of(text.encode())
    assert (automaton.accepts_from(words, 0) == len(words)) == accepted
    line = " " + " ".join(w.decode() for w in words) + " "
    assert bool(re.search(license_scan.as_pattern(TEMPLATE), line)) == accepted


def test_license_counts_and_spans():
    text = "x CC by! cc BY. All rights reserved - cc by"
    found = license_scan.Scanner().scan(text.encode())
    assert (found["n_words"], found["n_base"], found["first_word"], found["last_word"]) == (10, 4, 1, 8)
    assert found["base_labels"] == "cc-by,reserved"
    found = license_scan.Scanner().scan(b"a b Released under the MIT License.")
    assert found["matches"][0] == {"label": "mit-notice", "first": 2, "last": 6} and found["score"] == 1.0
    full = license_scan.TEMPLATES["mit"].replace('<<var;name="holders";words=8>>', "THE AUTHORS OR COPYRIGHT HOLDERS")
    full = full.replace("<<beginOptional>>(including the next paragraph)<<endOptional>>", "")
    assert "mit" in license_scan.Scanner().scan(full.encode())["labels"].split(",")
    assert "mit" not in license_scan.Scanner().scan(full.replace("merge", "emerge").encode())["labels"].split(",")


def test_license_scan_takes_odd_rows(odd, empty):
    rows = license_scan.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["score"] == 0 and r["first_word"] is None for r in rows)
    assert next(r for r in rows if r["doc_id"] == 5)["n_words"] == 60_000
    assert license_scan.scan(empty).count() == 0


def test_ranking_tells_good_from_bad_on_held_out_documents(spark):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice("the of and in house tree river stone was to".split()) for _ in range(rng.randrange(30, 90)))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "|"]) for _ in range(rng.randrange(30, 90)))
    rows = [(i, bad() if i % 4 == 0 else good(), "en", "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, rows)
    scored = quality_rank.score(docs, quality_rank.learn(docs, labels)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    assert all((r["predicted"] == 1) == (r["doc_id"] % 4 != 0) for r in scored if r["held_out"])


def test_ranking_takes_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    strength = quality_rank.learn(odd, labels)
    rows = quality_rank.score(odd, strength).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    nothing = quality_rank.learn(empty, labels)
    assert {r["score"] for r in quality_rank.score(odd, nothing).collect()} == {quality_rank.LIMIT}
    assert quality_rank.score(empty, strength).count() == 0


def exact(vectors, query, nearest):
    scores = [((np.array(v) * np.array(query[1])).sum(), i) for i, v in vectors if i != query[0]]
    return [i for _, i in sorted(scores, key=lambda s: (-s[0], s[1]))[:nearest]]


def test_neighbours_of_clustered_vectors_are_found_in_few_parts(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(32, 16)) * 3
    rows = [(i, [float(x) for x in centers[i % 32] + rng.normal(size=16)]) for i in range(3200)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    router = ann.fit(np.array([v for _, v in rows]), parts=16)
    assert router.probes <= 8
    found = ann.search_every(vectors, 50, nearest=10, sample=2000).collect()
    hits = sum(
        len({r["vec_id"] for r in found if r["query_id"] == q} & set(exact(rows, (q, v), 10))) for q, v in rows if q % 50 == 0
    )
    assert hits >= 0.9 * 10 * 64


def test_parts_searched_are_chosen_on_vectors_kept_from_fitting(monkeypatch):
    class Remembering(ann.Router):
        """Knows the vectors it was trained on, and nothing of others."""

        def log_probabilities(self, vectors):
            unknown = np.random.default_rng(1).random((len(vectors), 16))
            return np.array([self.weights[0].get(v.tobytes(), u) for v, u in zip(vectors, unknown)])

    known = lambda vectors, targets, rng: Remembering([{v.tobytes(): t for v, t in zip(vectors, targets)}])
    monkeypatch.setattr(ann, "train_router", known)
    assert ann.fit(np.random.default_rng(2).normal(size=(4096, 8)), parts=16).probes >= 14


def test_recall_on_random_vectors_beyond_the_sample(spark):
    rng = np.random.default_rng(7)
    values = rng.normal(size=(5 * ann.SAMPLE, 24))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id bigint, embedding array<double>")
    found = ann.search_every(vectors, 100).collect()
    asked = np.arange(0, len(values), 100)
    scores = values[asked] @ values.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = {(int(q), int(i)) for q, row in zip(asked, np.argpartition(-scores, 20, axis=1)[:, :20]) for i in row}
    assert len(true & {(r["query_id"], r["vec_id"]) for r in found}) >= 0.93 * len(true)


def test_parts_are_balanced():
    rng = np.random.default_rng(8)
    graph = ann.neighbour_graph(rng.normal(size=(512, 8)), 6)
    sizes = np.bincount(ann.balanced_parts(graph, 8, rng))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2


def test_neighbour_search_takes_odd_rows(spark):
    good = [1.0, 2.0]
    rows = [(0, good), (20, good), (20, good), (3, good), (2, [2.0, 4.0]), (40, None), (5, []), (6, [0.0, 0.0])]
    rows += [(7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, good), (60, [1.0]), (80, [-1.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, part string")
    found = ann.search_every(vectors, 20)
    lists = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert lists[0] == [(2, 10.0), (3, 5.0), (20, 5.0), (20, 5.0), (80, -1.0)]
    assert set(lists) == {0, 20, 80}
    assert ann.search_every(vectors.limit(0), 20).count() == 0
