"""The ranking is learned from all labelled documents, in blocks."""

from __future__ import annotations

import zlib

import numpy as np
from corpora import documents

from forgelens.llm import quality_rank


def _learnable(count: int) -> list[int]:
    return [i for i in range(count) if zlib.crc32(str(i).encode()) % quality_rank.FOLDS]


def test_every_labelled_document_is_learned_from(spark):
    # More than 20,000 labelled documents outside the held-out fold; one in fifty is bad.
    texts = [("the river of stone " if i % 50 else "BUY NOW!! ") * (1 + i % 3) + str(i) for i in range(26_000)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i % 50 != 0), 0) for i in range(26_000)], "doc_id bigint, quality int, toxic int")
    found = quality_rank.learn(docs, labels, pairs=100)
    learned = _learnable(26_000)
    rows = quality_rank.features([texts[i].encode() for i in learned])
    assert len(learned) > 20_000
    assert np.allclose(found.mean, rows.mean(axis=0), rtol=1e-12, atol=1e-12)
    assert np.allclose(found.scale, np.maximum(rows.std(axis=0), 1e-9), atol=1e-9)
    share = np.mean([i % 50 == 0 for i in learned])
    assert np.isclose(found.quantile, np.quantile(found.of(rows), share), atol=1e-9)
    good = np.array([i % 50 != 0 for i in learned])
    assert found.of(rows)[good].min() > found.of(rows)[~good].max()


def test_blocks_hold_each_row_once_and_the_rarer_label_as_often_as_needed(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "BLOCK", 50)
    monkeypatch.setattr(quality_rank, "BLOCK_LEAST", 8)
    width = quality_rank.features([b""]).shape[1]
    rng = np.random.default_rng(2)
    values = rng.normal(size=(1000, width))
    labels = (values[:, 0] > -2).astype(int)  # about 23 of the rarer one
    rows = spark.createDataFrame([(i, int(q), v.tolist()) for i, (q, v) in enumerate(zip(labels, values))], "doc_id bigint, quality int, features array<double>")
    counts = {label: int((labels == label).sum()) for label in (0, 1)}
    blocks = [row.asDict() for row in quality_rank._dealt(rows, counts).collect()]
    own = np.concatenate([quality_rank._own(row, width) for row in blocks])
    assert sorted(map(tuple, own)) == sorted(map(tuple, values))
    assert all(len(side) for row in blocks for side in quality_rank._matrices(row, width))
    found, plain = quality_rank.fit_blocks(rows, pairs=20_000), quality_rank.fit(values, labels)
    assert np.corrcoef(found.of(values), plain.of(values))[0, 1] > 0.98
    again = quality_rank.fit_blocks(rows.orderBy("features"), pairs=20_000)
    assert (again.weights == found.weights).all() and again.quantile == found.quantile


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "NEAR", 5)
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=500), np.repeat(rng.normal(size=9), 40), np.array([2.5])):
        table = spark.createDataFrame([(float(v),) for v in values], "value double")
        for share in (0.013, 0.77, 1.0):
            assert np.isclose(quality_rank.quantile(table, len(values), share), np.quantile(values, share), rtol=1e-14)
