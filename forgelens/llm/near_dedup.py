"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its word shingles, and has one minwise token for each
of ``TOKENS`` hash functions.  A tree sends a document down every branch whose
token a random choice of that node selects, ``1 / SIMILARITY`` of them on
average, so similar documents tend to share a branch and others seldom do.
Nodes of few documents are compared exhaustively; larger ones branch again, and
what is still large at the last level is compared in blocks.  ``TREES``
independent trees are grown.  A pair at the least similarity shares one branch
of a root on average, and a tree misses it with 0.37 if that is a small node.
Below a large node ``DEEPER`` times as many branches are chosen, so a pair whose
nodes are all large passes three levels with 0.56.  All trees miss it with a
probability between ``0.37 ** TREES`` and ``0.44 ** TREES``, 0.0007 % to 0.006 %.

Within a node, sketches are compared, and only the links that hold the node's
groups together leave it.  Groups that sketches connect are then compared on
their full sets, and only links that hold there count.

Documents with equal sets are joined before the trees and take part as one.
Null and empty texts, and texts without words, have an empty set and are linked
with nothing; so are rows without a ``doc_id``, which are kept.  Rows that share
a ``doc_id`` are one document, linked with all that one of them is linked with.
An empty table gives no rows; further columns are ignored.  Texts of any length
are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph
from . import shingles as sh

PERCENT = 80
TOKENS = 128
TREES = 12
LEVELS = 3
#: Below large nodes, so many times as many branches are chosen as at a root.
DEEPER = 2
SEED = 7
#: Nodes up to this size are compared exhaustively in one task, larger groups in blocks.
NODE_LIMIT = 4000
GROUP_LIMIT = 20_000
#: Bytes of text up to which a group is compared in one task, larger groups in blocks.
GROUP_BYTES = 32 << 20
#: Share of equal sketch bytes from which two documents may be similar: more than five
#: standard deviations under what a pair at the least similarity has.
SKETCH_SHARE = 0.60

SIGNATURE = "doc_id bigint, n_shingles bigint, n_bytes bigint, digest binary, tokens binary"


def signatures(documents: DataFrame, size: int, tokens: int = TOKENS, seed: int = SEED) -> DataFrame:
    """Set size, bytes of text, digest of the set, and minwise tokens of every row of ``documents``."""

    def signed(batches):
        factors = sh.multipliers(tokens, seed)
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"].to_pylist()
            for part in sh.chunks(texts):
                sets = sh.shingle_sets([text or b"" for text in texts[part]], size)
                full = [k for k, one in enumerate(sets) if len(one)]
                rows = sh.tokens([sets[k] for k in full], factors) if full else []
                packed: list[bytes | None] = [None] * len(sets)
                for k, row in zip(full, rows):
                    packed[k] = row.tobytes()
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(part.start, part.stop - part.start),
                        pa.array([len(one) for one in sets], pa.int64()),
                        pa.array([len(text or b"") for text in texts[part]], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "n_bytes", "digest", "tokens"],
                )

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(signed, SIGNATURE)


def branches(rows: DataFrame, trees: int, percent: int, seed: int, times: int = 1) -> DataFrame:
    """Children (node, doc_id) of ``rows`` (node, doc_id, tokens); ``node`` is null at the root of all trees."""

    def branched(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["doc_id"].to_numpy()
            held = np.frombuffer(b"".join(batch["tokens"].to_pylist()), dtype=np.uint32)
            held = held.reshape(len(ids), -1).astype(np.uint64)
            # A token is a value at a place; of all tokens, times * 100 / percent are chosen on average.
            named = sh.mix(held + (np.arange(held.shape[1], dtype=np.uint64) << np.uint64(32)))
            chosen = np.uint64(int((1 << 64) * times * 100 / (percent * held.shape[1])))
            nodes = batch["node"]
            if nodes.null_count:
                roots = [sh.mix(np.full((1, 1), seed * 1000 + tree, dtype=np.uint64)) for tree in range(trees)]
            else:
                roots = [nodes.to_numpy().view(np.uint64)[:, None]]
            for root in roots:
                path = sh.mix(named ^ root)
                at, place = np.nonzero(path < chosen)
                child = sh.mix(path[at, place] + np.uint64(1)) ^ named[at, place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), pa.array(ids[at])], names=["node", "doc_id"]
                )

    return rows.select("node", "doc_id", "tokens").mapInArrow(branched, "node bigint, doc_id bigint")


def in_blocks(rows: DataFrame, key: str, limit: int, bytes_limit: int | None = None) -> DataFrame:
    """``rows`` (with the size ``n`` of their group) so that no group exceeds about ``limit``.

    A larger group is cut into blocks by a hash of ``doc_id``, and each pair of
    blocks becomes a group of its own, so every two rows meet in one of them.
    With ``bytes_limit`` the same holds for ``n_bytes``, the bytes of the group:
    a row that has half of the limit or more tends to be alone in its block.
    """
    blocks = lambda n, most: F.when(F.col(n) > most, F.ceil(2 * F.col(n) / most)).otherwise(1)
    count = blocks("n", limit)
    if bytes_limit is not None:
        count = F.greatest(count, blocks("n_bytes", bytes_limit))
    block = F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int")
    pair = F.xxhash64(key, F.least("_block", "_other"), F.greatest("_block", "_other"))
    return (
        rows.withColumn("_blocks", count.cast("int"))
        .withColumn("_block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn(key, F.when(F.col("_blocks") > 1, pair).otherwise(F.col(key)))
        .drop("_blocks", "_block", "_other", "n", "n_bytes")
    )


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of a stream sorted by ``key``, and where their groups begin (one more at the end)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last == 0 and held and held[-1][key][-1].as_py() == keys[0]:
            held.append(batch)
            continue
        whole = [*held, batch.slice(0, last)] if last else held
        if whole:
            table = pa.Table.from_batches(whole)
            found = table[key].to_numpy()
            yield table, np.concatenate([[0], np.flatnonzero(np.diff(found)) + 1, [len(found)]])
        held = [batch.slice(last)]
    if held:
        table = pa.Table.from_batches(held)
        found = table[key].to_numpy()
        yield table, np.concatenate([[0], np.flatnonzero(np.diff(found)) + 1, [len(found)]])


def spanning(ids: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that hold a group's parts together, each with the least id of its part.

    ``linked(k, others)`` tells which of ``others`` are linked with ``k``.  A
    document is compared with all that no part has taken yet, so the members of
    a part are compared with each other only until they are known to belong.
    """
    left = np.argsort(ids, kind="stable")
    while len(left) > 1:
        root, left = left[0], left[1:]
        todo = [root]
        while todo and len(left):
            found = linked(todo.pop(), left)
            if found.any():
                reached = left[found]
                yield from ((int(ids[root]), int(ids[other])) for other in reached)
                todo.extend(reached)
                left = left[~found]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def by_group(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(F.col(key)).sortWithinPartitions(key)


def sketch_links(members: DataFrame, share: float = SKETCH_SHARE) -> DataFrame:
    """Links (a, b) within the nodes of ``members`` (node, doc_id, sketch)."""

    def compared(batches):
        for table, bounds in groups(batches, "node"):
            ids = table["doc_id"].to_numpy()
            sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            least = share * sketches.shape[1]
            sizes = np.diff(bounds)
            two = bounds[:-1][sizes == 2]
            near = (sketches[two] == sketches[two + 1]).sum(axis=1) >= least
            pairs = [(int(a), int(b)) for a, b in zip(ids[two[near]], ids[two[near] + 1])]
            for begin, end in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                own = sketches[begin:end]
                pairs += spanning(ids[begin:end], lambda k, rest: (own[rest] == own[k]).sum(axis=1) >= least)
            yield _edges(pairs)

    return by_group(members, "node").mapInArrow(compared, "a bigint, b bigint")


def exact_links(members: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that hold on full sets, within the groups of ``members`` (group, doc_id, text)."""

    def linked_in(sets: list[np.ndarray]):
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        lengths = np.array([len(one) for one in sets])
        begins = np.concatenate([[0], np.cumsum(lengths)])
        own = [flat[a:b] for a, b in zip(begins[:-1], begins[1:])]
        mark = np.zeros(int(flat.max()) + 1, dtype=bool)

        def linked(k: int, others: np.ndarray) -> np.ndarray:
            # Sets of too different sizes cannot reach the similarity.
            low, high = np.minimum(lengths[others], lengths[k]), np.maximum(lengths[others], lengths[k])
            fits = np.flatnonzero((100 * low >= percent * high) & (low > 0))
            found = np.zeros(len(others), dtype=bool)
            if len(fits):
                mark[own[k]] = True
                rest = others[fits]
                starts = np.concatenate([[0], np.cumsum(lengths[rest])[:-1]])
                common_size = np.add.reduceat(mark[np.concatenate([own[o] for o in rest])].astype(np.int64), starts)
                mark[own[k]] = False
                found[fits] = 100 * common_size >= percent * (lengths[rest] + lengths[k] - common_size)
            return found

        return linked

    def confirmed(batches):
        for table, bounds in groups(batches, "group"):
            ids, texts = table["doc_id"].to_numpy(), table["text"]
            pairs = []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if end - begin > 1:
                    own = [text or b"" for text in texts.slice(begin, end - begin).to_pylist()]
                    sets = [one for part in sh.chunks(own) for one in sh.shingle_sets(own[part], size)]
                    pairs += spanning(ids[begin:end], linked_in(sets))
            yield _edges(pairs)

    return by_group(members, "group").mapInArrow(confirmed, "a bigint, b bigint")


def grown(
    documents: DataFrame, size: int, percent: int, trees: int, levels: int, node_limit: int, seed: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, one row per different set, and the sketch links that the trees find."""
    signed = common.stored(signatures(documents, size, seed=seed), "near-signatures")
    known = signed.filter("doc_id is not null and n_shingles > 0")
    one = known.groupBy("digest").agg(F.min(F.struct("doc_id", "tokens")).alias("one"))
    sets = common.stored(one.select("digest", "one.doc_id", "one.tokens"), "near-sets")
    rows = sets.select(F.lit(None).cast("long").alias("node"), "doc_id", "tokens")
    leaves = []
    for level in range(levels):
        placed = common.stored(branches(rows, trees, percent, seed, DEEPER if level else 1).distinct(), "near-nodes")
        sizes = placed.groupBy(F.col("node").alias("of")).agg(F.count("*").alias("n")).filter("n > 1")
        shared = common.stored(placed.join(sizes, F.col("node") == F.col("of")).drop("of"), "near-shared")
        if level == levels - 1:
            leaves.append(in_blocks(shared, "node", node_limit))
            break
        leaves.append(shared.filter(F.col("n") <= node_limit).drop("n"))
        large = shared.filter(F.col("n") > node_limit)
        if large.isEmpty():
            break
        rows = large.select("node", "doc_id").join(sets.select("doc_id", "tokens"), "doc_id")
    members = leaves[0]
    for more in leaves[1:]:
        members = members.unionByName(more)
    return signed, sets, members


def sketch_of(tokens):
    """The last byte of every token, as binary."""
    # Tokens are little-endian 32-bit numbers: of eight hexadecimal digits, the first two are the last byte.
    return F.unhex(F.regexp_replace(F.hex(tokens), "(..)......", "$1"))


def link_components(
    documents: DataFrame,
    size: int,
    percent: int = PERCENT,
    trees: int = TREES,
    levels: int = LEVELS,
    node_limit: int = NODE_LIMIT,
    group_limit: int = GROUP_LIMIT,
    seed: int = SEED,
    group_bytes: int | None = None,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``documents``."""
    signed, sets, members = grown(documents, size, percent, trees, levels, node_limit, seed)
    sketches = sets.select("doc_id", sketch_of(F.col("tokens")).alias("sketch"))
    # Sides that grow with the corpus are merged at every size, never broadcast.
    near = common.stored(sketch_links(members.join(sketches.hint("merge"), "doc_id")), "near-links")
    parts = common.stored(graph.components(near, "near-parts"), "near-parts")
    # All rows of a doc_id are compared, so the bytes of all count.
    weighed = signed.groupBy(F.col("doc_id").alias("id")).agg(F.sum("n_bytes").alias("n_bytes"))
    sizes = parts.join(weighed.hint("merge"), "id").groupBy(F.col("component").alias("group"))
    sizes = sizes.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"))
    grouped = in_blocks(
        parts.withColumnRenamed("component", "group").join(sizes, "group").withColumnRenamed("id", "doc_id"),
        "group",
        group_limit,
        group_bytes or GROUP_BYTES,
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    links = common.stored(exact_links(grouped.join(texts.hint("merge"), "doc_id"), size, percent), "near-exact")
    # Rows of one doc_id with different sets link those sets.
    first = sets.select("digest", F.col("doc_id").alias("first"))
    owner = F.when(F.col("doc_id").isNotNull(), F.col("first")).alias("first")
    owners = signed.join(first, "digest", "left").select("doc_id", "n_shingles", owner)
    owners = common.stored(owners, "near-owners")
    several = owners.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a <> b")
    links = links.union(owners.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("first").alias("b")))
    found = common.stored(graph.components(links, "near-components"), "near-components")
    joined = owners.join(found, F.col("first") == F.col("id"), "left")
    component = F.coalesce("component", "first", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, size: int = 5, **options) -> DataFrame:
    """``documents`` with one row of each component, and all rows without a ``doc_id``."""
    kept = link_components(documents, size, **options).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = documents.filter("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(documents.filter("doc_id is null"))
