from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from samples import envelope_lines, sample_payloads, write_lines  # noqa: E402

from forgelens.session import build_session  # noqa: E402
from forgelens.sources import landing  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_raw(spark, tmp_path_factory):
    """The sample records, landed as JSON lines, loaded and read back as raw tables."""
    base = tmp_path_factory.mktemp("landing")
    tables = {}
    for resource, payloads in sample_payloads().items():
        folder = base / resource / "year=2026" / "month=04" / "day=25"
        write_lines(folder, envelope_lines(resource, payloads))
        landed = landing.read(spark, str(base), resource)
        from pyspark.sql import functions as F

        landing.write_raw(landing.to_raw(landed, F.lit("2026-04-25 06:30:00")), f"{base}/raw/{resource}")
        tables[resource] = landing.read_raw(spark, f"{base}/raw/{resource}")
    return tables


@pytest.fixture(scope="session")
def staged(sample_raw):
    from forgelens.plans.staging import stage

    return {resource: stage(raw, resource) for resource, raw in sample_raw.items()}
