"""Sharding by a two-pass external shuffle.

The first pass scatters records over memory-sized buckets by seeded hashes; the
second orders each bucket by a Fisher-Yates shuffle and writes it.  A bucket is
a part of one shard, so the parts of a shard, one after the other, are a random
order of the whole shard.

A record's shard is the one whose hash with the record's key is the largest, so
it depends on the key and the number of shards only, and one more shard takes
records from all others and moves none between them.

Records without a key share one shard, spread over its parts by their text.
Null and empty texts count one byte.  Rows that are equal in key and text are
interchangeable.  An empty table gives no rows.  All columns of a record travel
inside ``row``, so no name can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_dir

SHARDS = 16
SEED = 20260517
#: Bytes of text that one bucket holds on average.
BUCKET_BYTES = 32 << 20


def choose_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard with the largest hash; a tie goes to the higher number."""
    hashes = [F.struct(F.xxhash64(key, F.lit(seed), F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return F.greatest(*hashes)["s"]


def fisher_yates(count: int, rng: np.random.Generator) -> np.ndarray:
    """A random order of ``count`` places: from the last on, swap with a place not after it."""
    order = list(range(count))
    draws = rng.integers(0, np.arange(count, 1, -1)) if count > 1 else []
    for last, other in zip(range(count - 1, 0, -1), draws):
        order[last], order[other] = order[other], order[last]
    return np.array(order, dtype=np.int64)


def external_shuffle(
    records: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``row`` (all columns of a record), shard, slot from 0 without gaps, and grown_shard."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1
    total = records.agg(F.sum(size.cast("long"))).first()[0] or 0
    parts = max(1, -(-total // (shards * bucket_bytes)))
    placed = records.select(
        F.struct("*").alias("row"),
        choose_shard(F.col(key), shards, seed).alias("shard"),
        choose_shard(F.col(key), shards + 1, seed).alias("grown_shard"),
        F.xxhash64(F.col(key), F.col(text), F.lit(seed)).alias("tie"),
    ).withColumn("bucket", F.col("shard").cast("long") * parts + F.pmod(F.xxhash64("tie", F.lit(seed)), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))
    )
    schema = placed.select("row", "shard", F.lit(0).cast("long").alias("slot"), "grown_shard").schema

    def shuffled(rows: pa.Table, start: pa.Table) -> pa.Table:
        if not rows.num_rows:  # nothing but an offset came: no such bucket
            return pa.table({"row": rows["row"], "shard": rows["shard"], "slot": pa.array([], pa.int64()), "grown_shard": rows["grown_shard"]})
        bucket = rows["bucket"][0].as_py()
        # Rows come in any order; from a fixed one, the seed gives the same shuffle again.
        fixed = np.lexsort([rows["tie"].to_numpy()])
        order = fixed[fisher_yates(rows.num_rows, np.random.default_rng([seed, bucket]))]
        slots = start["start"][0].as_py() + np.arange(rows.num_rows, dtype=np.int64)
        out = rows.select(["row", "shard", "grown_shard"]).take(pa.array(order))
        return pa.table({"row": out["row"], "shard": out["shard"], "slot": slots, "grown_shard": out["grown_shard"]})

    return placed.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(shuffled, schema)


def write_shards(shuffled: DataFrame, path: str) -> DataFrame:
    """One folder per shard, each file in the order of its slots; read again from there."""
    shuffled.write.partitionBy("shard").parquet(path)
    return shuffled.sparkSession.read.schema(shuffled.schema).parquet(path)


def sharded(records: DataFrame, **options) -> DataFrame:
    """Shards of ``records`` in the shared folder."""
    return write_shards(external_shuffle(records, **options), scratch_dir(records.sparkSession, "shards"))
