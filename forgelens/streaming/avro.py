"""Avro values of the processed topics (needs Spark's Avro package on the class path)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Avro types of the record fields.
AVRO_TYPES = {
    "bigint": "long",
    "string": "string",
    "timestamp": {"type": "long", "logicalType": "timestamp-millis"},
}

# A registry-framed value starts with a zero byte and a four-byte schema id.
FRAME_BYTES = 5


def avro_schema(name: str, record: dict[str, tuple[str, bool]]) -> str:
    """Schema text of a record, whose name may carry its namespace; an optional field is a union with null."""
    fields = []
    for field, (kind, required) in record.items():
        if required:
            fields.append({"name": field, "type": AVRO_TYPES[kind]})
        else:
            fields.append({"name": field, "type": ["null", AVRO_TYPES[kind]], "default": None})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def unframed(value: Column) -> Column:
    """The Avro body of a registry-framed value."""
    return F.substring(value, FRAME_BYTES + 1, F.length(value) - FRAME_BYTES)


def encode(rows: DataFrame, name: str, record: dict[str, tuple[str, bool]]) -> DataFrame:
    """Rows as messages without a key."""
    from pyspark.sql.avro.functions import to_avro

    body = F.struct(*record)
    return rows.select(F.lit(None).cast("binary").alias("key"), to_avro(body, avro_schema(name, record)).alias("value"))


def decode(messages: DataFrame, name: str, record: dict[str, tuple[str, bool]]) -> DataFrame:
    """Typed rows of a processed topic."""
    from pyspark.sql.avro.functions import from_avro

    row = from_avro(unframed(F.col("value")), avro_schema(name, record))
    return messages.select(row.alias("r")).select("r.*")
