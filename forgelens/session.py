"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every relation assumes.  Day and hour arithmetic is done in UTC, and
# AQE splits skewed join and rebalance partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Payload columns are written shredded, so a scan reads single JSON paths.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # State of streams stays on the executors' disks; a checkpoint holds what changed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Without it, shuffle files stay on the executors' disks until the driver happens to collect garbage.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Scratch folders of sessions in local mode, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "forgelens", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session; ``extra`` keys use ``__`` in place of ``.``."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in here leave no shuffle files, so that a chain of them needs the disk of its largest one.

    Not for a whole session: a frame that is collected twice would run twice.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``.

    Executors on other machines have to see it, so a temporary folder of this
    machine is used only when Spark itself runs in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FOLDERS.get(spark.sparkContext.applicationId)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL_FOLDERS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="forgelens-")
    return os.path.join(base, f"{label}-{uuid.uuid4().hex[:12]}")
