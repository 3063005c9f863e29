"""Near-dedup, suffix dedup and the pipeline against plain comparison of all texts."""

from __future__ import annotations

import hashlib
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from corpora import documents, random_texts
from pyspark.sql import functions as F

import corpus_pipeline
from forgelens.llm import deep_shallow, graph, near_dedup, suffix_dedup
from forgelens.llm import shingles as sh

ROOT = Path(__file__).resolve().parents[2]


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain_components(texts: dict[int, str], size: int) -> dict[int, int]:
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 80 * len(sets[a] | sets[b]) and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("limits", [{}, {"node_limit": 4, "group_limit": 6}])
def test_components_equal_those_of_all_pairs(spark, limits):
    texts = dict(enumerate(random_texts(9, 160)))
    rows = near_dedup.link_components(documents(spark, [(i, t, "en", "s") for i, t in texts.items()]), 4, trees=14, **limits).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(texts, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingle_set(t, 4)) for i, t in texts.items()}


def test_pairs_in_large_nodes_meet(spark):
    # Sets of words, each pair at 90 of 112 or 95 of 113; with this limit every node that a pair shares is large.
    rows = []
    for i in range(4000):
        shared = [f"s{i}w{k}" for k in range(90 + 5 * (i % 2))]
        for side in (0, 1):
            own = [f"o{i}w{side}x{k}" for k in range(11 - 2 * (i % 2))]
            rows.append((2 * i + side, " ".join(shared + own), "en", "s"))
    docs = documents(spark, rows)
    p = near_dedup
    *_, members = p.grown(docs, 1, p.PERCENT, p.TREES, p.LEVELS, 1, p.SEED)
    met = members.groupBy("node").agg(F.collect_set(F.floor(F.col("doc_id") / 2)).alias("pair"), F.count_distinct("doc_id").alias("n"))
    assert met.filter("n > 1").select(F.explode("pair")).distinct().count() == 4000


def test_groups_of_long_texts_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(500)]
    texts = {i: " ".join(base[:-1] + [f"own{i}"]) for i in range(60)}
    texts |= {100 + i: " ".join(rng.permutation(base)) for i in range(5)}
    seen, sent = [], near_dedup.exact_links

    def watched(members, size, percent):
        seen.append(members.groupBy("group").agg(F.sum(F.length("text")).alias("bytes")).agg(F.max("bytes")).first()[0])
        return sent(members, size, percent)

    monkeypatch.setattr(near_dedup, "exact_links", watched)
    monkeypatch.setattr(near_dedup, "GROUP_BYTES", 40_000, raising=False)
    docs = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    rows = near_dedup.link_components(docs, 4).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: 0 if i < 60 else i for i in texts}
    assert 0 < seen[0] <= 60_000 < sum(len(t) for i, t in texts.items() if i < 60)


def test_near_dedup_takes_odd_rows(odd, empty):
    rows = near_dedup.link_components(odd, 4).collect()
    assert len(rows) == odd.count()
    found = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in rows}
    assert found[1, 0] == (1, True) and found[2, 0] == (2, True) and found[3, 0] == (3, True) and found[4, 1] == (4, True)
    assert {v for (i, _), v in found.items() if i == 7} == {(6, False)}
    assert all(v == (None, True) for (i, _), v in found.items() if i is None)
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "None", "None"])
    assert near_dedup.link_components(empty, 4).count() == 0 and near_dedup.keep_one(empty).count() == 0


def test_rows_of_one_id_with_different_texts_are_one_document(spark):
    a, b = "one two three four five six seven", "red green blue white black brown pink"
    docs = documents(spark, [(1, a, "en", "s"), (2, a, "en", "s"), (2, b, "en", "s"), (3, b, "en", "s"), (4, "x y z", "en", "s")])
    found = {(r["doc_id"], r["component_id"]) for r in near_dedup.link_components(docs, 4).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50, 90)] + [(200, i) for i in range(100, 140)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in found} == {i: 50 for i in range(50, 91)} | {i: 100 for i in [*range(100, 140), 200]}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_sets_do_not_depend_on_neighbours():
    texts = [t.encode() for t in random_texts(2, 30)] + [b"", b"a", b"A  b\tc"]
    together = sh.shingle_sets(texts, 3)
    for text, found in zip(texts, together):
        assert len(found) == len(shingle_set(text.decode(), 3))
        assert np.array_equal(found, sh.shingle_sets([text], 3)[0])


def plain_cut(texts: dict[int, bytes], length: int) -> dict[int, np.ndarray]:
    first: dict[bytes, int] = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - length + 1):
            first.setdefault(texts[i][k : k + length], i)
    gone = {}
    for i, text in texts.items():
        gone[i] = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - length + 1):
            if first[text[k : k + length]] < i:
                gone[i][k : k + length] = True
    return gone


@pytest.mark.parametrize(
    "sizes", [{}, {"chunk_bytes": 900, "bucket_bytes": 2000}, {"chunk_bytes": 900, "bucket_bytes": 2000, "hot_chunks": 1}]
)
def test_cuts_equal_those_of_all_strings(spark, sizes):
    texts = {i * 3 - 60: t for i, t in enumerate(random_texts(4, 80, vocabulary=12))}
    texts |= {500: "ab" * 200, 501: "a" * 300, 502: "ba" * 30 + "x", 503: "a" * 50, 504: "a" * 49}
    docs = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    cut = suffix_dedup.shared_strings(docs, **sizes)
    rows = cut.select("row.doc_id", "n_bytes", "spans", *suffix_dedup.digests(cut)).collect()
    want = plain_cut({i: t.encode() for i, t in texts.items()}, 50)
    assert len(rows) == len(texts) and sum(r["n_removed"] for r in rows) > 0
    for row in rows:
        data, gone = np.frombuffer(texts[row["doc_id"]].encode(), np.uint8), want[row["doc_id"]]
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        assert [tuple(s) for s in row["spans"]] == list(zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(data), gone.sum(), (edge == 1).sum())
        assert row["kept_sha256"] == hashlib.sha256(data[~gone].tobytes()).hexdigest()


def test_suffix_dedup_takes_odd_rows(odd, empty):
    cut = suffix_dedup.shared_strings(odd, odd.columns)
    rows = [(r["row"]["doc_id"], r["n_bytes"], r["n_removed"]) for r in cut.select("row", "n_bytes", *suffix_dedup.digests(cut)).collect()]
    size = len("same text of two rows, repeated as it is\n") * 9
    assert len(rows) == odd.count()
    assert (7, size, size) in rows and rows.count((6, size, 0)) == 2 and (None, size, 0) in rows and (1, 0, 0) in rows
    left = suffix_dedup.cut_repeats(odd)
    assert left.columns == odd.columns and left.filter("doc_id = 7").first()["text"] == ""
    assert left.filter("doc_id = 1").first()["text"] is None
    assert suffix_dedup.shared_strings(empty).count() == 0 and suffix_dedup.cut_repeats(empty).count() == 0


def test_cuts_keep_characters_whole(spark):
    a, b = "é" * 40 + "x", "ñ" + "é" * 40 + "y"
    docs = documents(spark, [(1, a, "en", "s"), (2, b, "en", "s"), (3, "x" + "é" * 26, "en", "s")])
    left = {r["doc_id"]: r["text"] for r in suffix_dedup.cut_repeats(docs).collect()}
    assert left[1] == a and left[2] == "ñy"
    assert "�" not in "".join(left.values())


def test_deep_shallow_order_equals_a_plain_sort():
    rng = np.random.default_rng(1)
    for trial in range(60):
        count = int(rng.integers(1, 200))
        data = rng.integers(97, 98 + int(rng.integers(1, 3)), 900).astype(np.uint8)
        starts = rng.integers(0, 850, count) if trial % 2 else rng.integers(0, 12, count) * 60
        group = rng.integers(0, 3, count)
        order, classes = deep_shallow.sort(deep_shallow.as_words(data, starts, 50), group)
        keys = [(group[i], data[starts[i] : starts[i] + 50].tobytes()) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(count))
        assert all((classes[i] == classes[i - 1]) == (keys[i] == keys[i - 1]) for i in range(1, count))


def test_every_stage_takes_odd_rows(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, "unused")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found.collect()
        assert stage(spark, empty, "unused").count() == 0


def test_stages_do_what_their_parts_do(spark, tmp_path):
    rows = [(i, t + " the of and in" * 30, "en", f"s{i % 3}") for i, t in enumerate(random_texts(12, 60))]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    by_hand = docs
    for _, stage in corpus_pipeline.STAGES:
        by_hand = stage(spark, by_hand, str(tmp_path))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, found.collect())) == sorted(map(str, by_hand.collect()))
    near = corpus_pipeline.STAGES[1][1](spark, docs, "unused")
    want = plain_components({i: t for i, t, *_ in rows}, 5)
    assert {r["doc_id"] for r in near.collect()} == {i for i, c in want.items() if i == c}
    cut = corpus_pipeline.STAGES[2][1](spark, docs, "unused").agg(F.sum(F.length("text"))).first()[0]
    assert cut < sum(len(t) for _, t, *_ in rows)


def test_words_of_long_texts_are_hashed_in_segments(monkeypatch):
    texts = [t.encode() for t in [*random_texts(9, 40), "", "  ", "one", "x" * 300, " lead", "tail "]]
    whole = sh.word_hashes(texts)
    sets = sh.shingle_sets(texts, 4)
    for most in (1, 7, 50):
        monkeypatch.setattr(sh.segments, "__defaults__", (most,))
        monkeypatch.setattr(sh.chunks, "__defaults__", (most,))
        words, bounds = sh.word_hashes(texts)
        assert words.tolist() == whole[0].tolist() and bounds.tolist() == whole[1].tolist()
        assert [s.tolist() for s in sh.shingle_sets(texts, 4)] == [s.tolist() for s in sets]
    assert [len(t.split()) for t in texts] == np.diff(whole[1]).tolist()
    assert sh.segments(b"ab cd  ef", 2) == [b"ab", b" cd", b"  ef"]


def test_a_text_of_64_mb_takes_bounded_memory():
    """In a process of its own, so that its peak is that of the one text."""
    code = """
import resource
from forgelens.llm import pieces, quality_rank, shingles
text = b"".join(b"w%d of the " % (i % 50_000) for i in range(4_600_000))[: 64 << 20]
shingles.shingle_sets([text], 5)
quality_rank.features([text])
with open(pieces.MODEL, "rb") as file:
    codec = pieces.UnitCodec(file.read(), 1)
assert codec.checked([text.decode()])[1:] == ([True], [True])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True)
    assert int(done.stdout) < 1500
