"""Quality scores by Bradley-Terry ranking.

A document's strength is a weighted sum of features of its text.  Weights are
learned from pairs of a preferred and a rejected document, by logistic loss on
the difference of their features.  A document counts as good from the quantile
of the strengths on that the rejected documents' share gives.

Every labelled document outside the held-out fold takes part in the means, in a
pair or more, and in the quantile.  They are dealt into blocks of both labels
(the rarer one goes to several blocks, if there is too little of it); each step
sums over the blocks.  Every whole text is scored.  Null and empty texts have the
features of no text and a score like any other.  If there is one label only, all
scores are equal.  A document with several labels takes the best.  Repeated rows
are scored one by one, further columns are ignored, and an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, quality_rules
from . import shingles as sh

FOLDS = 5
#: Pairs at least, where each document has a partner of the other label.
PAIRS = 60_000
#: Rows of the more frequent label in a block, and of the rarer one at least.
BLOCK, BLOCK_LEAST = 4_000, 64
#: Rows of sums, and of values near a quantile, that come to the driver at most.
SUMS, NEAR = 256, 10_000
BINS = 1_000
RIDGE = 1.0
#: The score of a document at the quantile.
LIMIT = 0.3
SEED = 5

_KINDS = np.full(256, 5, dtype=np.int64)  # other ASCII
for _kind, _bytes in enumerate(
    [
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b" \t\n\v\f\r",
        b".,;:?'\"()-",
    ]
):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:] = 6
_KINDS[ord("!")] = 7
_KINDS[ord("|")] = 8
_KINDS[list(b"#*$%&<>")] = 9
KINDS = 10

COMMON = np.unique(
    sh.word_hashes([" ".join(sorted({w for words in quality_rules.COMMON_WORDS.values() for w in words})).encode()])[0]
)


def kind_counts(texts: list[bytes]) -> np.ndarray:
    """Bytes of each kind in each text; long texts are counted in slices."""
    counts = np.zeros((len(texts), KINDS), np.int64)
    for row, text in enumerate(texts):
        for start in range(0, len(text), sh.CHUNK_BYTES):
            data = np.frombuffer(text, np.uint8, min(sh.CHUNK_BYTES, len(text) - start), start)
            counts[row] += np.bincount(_KINDS[data], minlength=KINDS)
    return counts


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    lengths = np.array([len(text) for text in texts])
    counts = kind_counts(texts)
    shares = counts / np.maximum(lengths, 1)[:, None]
    words, bounds = sh.word_hashes(texts)
    usual = np.concatenate([[0], np.cumsum(np.isin(words, COMMON))])
    rows = []
    for text, begin, end in zip(texts, bounds[:-1], bounds[1:]):
        own = words[begin:end]
        count = max(len(own), 1)
        times = np.unique(own, return_counts=True)[1]
        runs = sh.mix(own[:-1] * np.uint64(3) + own[1:])
        lines = text.split(b"\n")
        rows.append(
            [
                np.log1p(len(own)),
                len(text) / count,
                len(times) / count,
                times.max() / count if len(times) else 0.0,
                len(np.unique(runs)) / max(len(runs), 1),
                (usual[end] - usual[begin]) / count,
                len(set(lines)) / len(lines),
                np.log1p(len(text) / len(lines)),
            ]
        )
    plain = np.concatenate([shares, np.array(rows).reshape(len(texts), -1)], axis=1)
    # Roots spread out small shares.
    return np.concatenate([plain, np.sqrt(shares)], axis=1)


@dataclass
class Strength:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    quantile: float = 0.0

    def of(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, ``LIMIT`` at the quantile."""
        return 1 / (1 + (1 - LIMIT) / LIMIT * np.exp(np.clip(self.quantile - self.of(rows), -500, 500)))


def _scaled(rows: np.ndarray, strength: Strength) -> np.ndarray:
    return np.clip((rows - strength.mean) / strength.scale, -6, 6)


def _slope_and_curve(difference: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the pairs' loss."""
    wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
    return -difference.T @ wrong, (difference * (wrong * (1 - wrong))[:, None]).T @ difference


def _newton(size: int, ridge: float, derivatives: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    weights = np.zeros(size)
    for _ in range(25):
        slope, curve = derivatives(weights)
        step = np.linalg.solve(curve + ridge * np.eye(size), slope + ridge * weights)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = SEED) -> Strength:
    """Weights that rank rows of label 1 over those of label 0, from rows in memory and as many drawn pairs."""
    size = rows.shape[1]
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return Strength(np.zeros(size), np.ones(size), np.zeros(size))
    strength = Strength(rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-9), np.zeros(size))
    scaled = _scaled(rows, strength)
    rng = np.random.default_rng(seed)
    difference = scaled[rng.choice(good, pairs)] - scaled[rng.choice(bad, pairs)]
    strength.weights = _newton(size, ridge, lambda weights: _slope_and_curve(difference, weights))
    strength.quantile = float(np.quantile(strength.of(rows), len(bad) / len(labels)))
    return strength


def _dealt(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Blocks of both labels: a row of each, with its features as two matrices.

    A label of which the blocks would get too little goes to several blocks;
    ``own_good`` and ``own_bad`` rows, the first ones, are in this block only.
    """
    blocks = -(-max(counts.values()) // BLOCK)
    copies = {label: min(blocks, -(-BLOCK_LEAST * blocks // count)) for label, count in counts.items()}
    first = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    often = F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0])
    placed = rows.select("*", first.alias("first"), F.explode(F.sequence(F.lit(0), often - 1)).alias("copy")).withColumn(
        "block", F.pmod(F.col("first") + F.col("copy"), F.lit(blocks))
    )

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("copy", "ascending"), ("doc_id", "ascending")])
        found = {"block": pa.array([group["block"][0].as_py()], pa.int32())}
        for name, label in (("good", 1), ("bad", 0)):
            part = group.filter(pc.equal(group["quality"], label))
            found[f"own_{name}"] = pa.array([pc.sum(pc.equal(part["copy"], 0)).as_py() or 0], pa.int32())
            found[name] = pa.array([pc.list_flatten(part["features"]).to_numpy().tobytes()], pa.binary())
        return pa.table(found)

    kinds = "block int, own_good int, good binary, own_bad int, bad binary"
    return common.stored(placed.groupBy("block").applyInArrow(packed, kinds), "rank-blocks")


def _matrices(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[name]).reshape(-1, width) for name in ("good", "bad"))


def _own(row: dict, width: int) -> np.ndarray:
    good, bad = _matrices(row, width)
    return np.concatenate([good[: row["own_good"]], bad[: row["own_bad"]]])


def _each(blocks: DataFrame, make: Callable[[dict], np.ndarray], schema: str) -> DataFrame:
    """What ``make`` finds in each block, an array of numbers."""

    def made(batches):
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                values = pa.array([make(row)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int32()), values], names=["block", "values"])

    return blocks.mapInArrow(made, schema)


def _summed(blocks: DataFrame, make: Callable[[dict], np.ndarray]) -> np.ndarray:
    """The sum over all blocks, in a fixed order."""
    kinds = "block int, values array<double>"

    def added(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        total = pc.list_flatten(group["values"]).to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"block": group["block"][:1].cast(pa.int32()), "values": pa.array([total], pa.list_(pa.float64()))})

    some = F.pmod(F.col("block"), F.lit(SUMS)).alias("some")
    sums = _each(blocks, make, kinds).groupBy(some).applyInArrow(lambda key, group: added(group), kinds).collect()
    return np.sum([row["values"] for row in sorted(sums, key=lambda row: row["block"])], axis=0)


def _ranked(values: DataFrame, place: int) -> float:
    """The value at a place, from 0, in ascending order: counts of ever narrower bins, then the few values left."""
    value = F.col("value")
    low, high, left = values.agg(F.min(value), F.max(value), F.count(value)).first()
    while low < high:
        within = values.filter(value.between(low, high))
        if left <= NEAR:
            return sorted(row["value"] for row in within.collect())[place]
        of = F.least(F.floor((value - low) / (high - low) * BINS), F.lit(BINS - 1))
        for row in within.groupBy(of.alias("bin")).agg(F.min(value), F.max(value), F.count(value)).orderBy("bin").collect():
            if place < row[3]:
                low, high, left = row[1:]
                break
            place -= row[3]
    return low


def quantile(values: DataFrame, count: int, share: float) -> float:
    """The exact quantile of a column ``value``, between two values in proportion."""
    place = share * (count - 1)
    below = int(place)
    return float(np.quantile([_ranked(values, below), _ranked(values, min(below + 1, count - 1))], place - below))


def fit_blocks(rows: DataFrame, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = SEED) -> Strength:
    """The same from rows (doc_id, quality, features) of any number, each in a pair or more."""
    width = features([b""]).shape[1]
    counts = {row["quality"]: row["count"] for row in rows.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Strength(np.zeros(width), np.ones(width), np.zeros(width))
    blocks, count = _dealt(rows, counts), sum(counts.values())
    mean = _summed(blocks, lambda row: _own(row, width).sum(axis=0)) / count
    square = _summed(blocks, lambda row: ((_own(row, width) - mean) ** 2).sum(axis=0)) / count
    strength = Strength(mean, np.maximum(np.sqrt(square), 1e-9), np.zeros(width))
    rounds = -(-pairs // max(counts.values()))

    def derivatives(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def found(row: dict) -> np.ndarray:
            """Each row of the longer side meets ``rounds`` rows of the other, which are used alike."""
            sides = [_scaled(side, strength) for side in _matrices(row, width)]
            longer, shorter = sorted((0, 1), key=lambda side: -len(sides[side]))
            size = len(sides[longer]) if len(sides[shorter]) else 0
            turns = np.resize(np.arange(len(sides[shorter])), (rounds, size))
            chosen = np.random.default_rng([seed, row["block"]]).permuted(turns, axis=1).ravel()
            difference = np.tile(sides[longer][:size], (rounds, 1)) - sides[shorter][chosen]
            slope, curve = _slope_and_curve(difference * (1 if longer == 0 else -1), weights)
            return np.concatenate([slope, curve.ravel()])

        sums = _summed(blocks, found)
        return sums[:width], sums[width:].reshape(width, width)

    strength.weights = _newton(width, ridge, derivatives)
    strengths = _each(blocks, lambda row: strength.of(_own(row, width)), "block int, values array<double>")
    values = common.stored(strengths.select(F.explode("values").alias("value")), "rank-strengths")
    strength.quantile = quantile(values, count, counts[0] / count)
    return strength


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _plain(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _by_parts(batch: pa.RecordBatch):
    texts = batch["text"].to_pylist()
    for part in sh.chunks(texts):
        yield batch.slice(part.start, part.stop - part.start), features([text or b"" for text in texts[part]])


def learn(documents: DataFrame, labels: DataFrame, **options) -> Strength:
    """A strength learned from all labelled documents outside the held-out fold."""
    doc_id = F.col("doc_id")
    known = (
        labels.select(doc_id.cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(doc_id.isNotNull() & F.col("quality").isin(0, 1) & ~held_out(doc_id))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )

    def featured(batches):
        for batch in batches:
            for part, rows in _by_parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(list(rows), pa.list_(pa.float64()))], names=["doc_id", "features"]
                )

    # Features are made before the join, so that texts are not moved.
    asked = _plain(documents).filter(doc_id.isNotNull() & ~held_out(doc_id))
    rows = asked.mapInArrow(featured, "doc_id bigint, features array<double>").join(known, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max(F.struct("quality", "features")).alias("row")).select("doc_id", "row.*")
    return fit_blocks(common.stored(rows, "rank-features"), **options)


def score(documents: DataFrame, strength: Strength) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def scored(batches):
        for batch in batches:
            for part, rows in _by_parts(batch):
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(strength.scores(rows), pa.float64())], names=["doc_id", "score"]
                )

    found = _plain(documents).mapInArrow(scored, "doc_id bigint, score double")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
