"""Sharding recomputed by hand, and the ranking's fit against a plain minimizer."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import xxhash
from corpora import documents, random_texts

from forgelens.llm import common, quality_rank, queries, sharding


def spark_hash(key: int, *numbers: int) -> int:
    """What Spark's xxhash64 gives for a long and some ints, as a signed number."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    for number in numbers:
        h = xxhash.xxh64_intdigest(struct.pack("<i", number), seed=h)
    return h - (1 << 64) if h >> 63 else h


def plain_shard(key: int, shards: int) -> int:
    return max(range(shards), key=lambda s: (spark_hash(key, sharding.SEED, s), s))


def test_shards_sizes_checksums_and_growth_equal_those_made_by_hand(spark, tmp_path):
    texts = [*random_texts(3, 300), "", None, "é𐍈"]
    rows = [(i * 31 - 500, t, "en", "a") for i, t in enumerate(texts)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.queries()["op3_sharding"](spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, *_ in rows}
    for key, text, _, _ in rows:
        data, row = (text or "").encode(), got[key]
        assert (row["size"], row.text_crc32, row.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert (row.shard, row.grown_shard) == (plain_shard(key, 16), plain_shard(key, 17))
        assert row.grown_shard in (row.shard, 16)
    for shard in range(16):
        slots = sorted(r.slot for r in got.values() if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_weights_are_those_of_a_plain_minimizer():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 5)) * [1, 2, 0.5, 3, 1] + 1
    labels = (rows @ [1, -0.5, 0.3, 0.1, 0] + rng.normal(size=400) > 0.5).astype(int)
    found = quality_rank.fit(rows, labels, pairs=2000)
    # The same pairs; the loss is lowered by steps along its slope only.
    scaled = np.clip((rows - rows.mean(axis=0)) / rows.std(axis=0), -6, 6)
    draw = np.random.default_rng(quality_rank.SEED)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    difference = scaled[draw.choice(good, 2000)] - scaled[draw.choice(bad, 2000)]

    def loss(w):
        return np.logaddexp(0, -difference @ w).sum() + quality_rank.RIDGE / 2 * w @ w

    weights, step = np.zeros(5), 1e-3
    for _ in range(20_000):
        slope = quality_rank.RIDGE * weights - difference.T @ (1 / (1 + np.exp(difference @ weights)))
        while loss(weights - step * slope) > loss(weights):
            step /= 2
        weights = weights - step * slope
        if np.abs(slope).max() < 1e-6:
            break
    assert np.allclose(found.weights, weights, atol=1e-5)
    assert loss(found.weights) <= loss(weights) + 1e-9
    strength = scaled @ weights
    assert np.isclose(found.quantile, np.quantile(strength, len(bad) / len(labels)), atol=1e-4)
    score = found.scores(rows)
    assert (np.argsort(score, kind="stable") == np.argsort(found.of(rows), kind="stable")).all()
    assert ((score >= quality_rank.LIMIT) == (found.of(rows) >= found.quantile)).mean() > 0.99


def test_a_sample_holds_each_key_once_and_no_more_than_asked(spark):
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v").repartition(9)
    some = common.sample_of(hot, ["k"], 500).collect()
    # A hot key counts among the rows, so there may be fewer keys than asked for.
    assert 400 < len(some) == len({r.k for r in some}) <= 500
    again = common.sample_of(hot.orderBy("v"), ["k"], 500).collect()
    assert {(r.k, r.v) for r in some} == {(r.k, r.v) for r in again}
    assert common.sample_of(spark.range(20), ["id"], 500).count() == 20
    assert common.sample_of(spark.range(0), ["id"], 500).count() == 0
