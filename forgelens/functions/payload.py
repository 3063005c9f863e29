"""Typed access to the semi-structured payload column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(paths: Mapping[str, str]) -> T.StructType:
    """A schema for JSON text with the leaves of ``paths`` (path, type): lists as they are, all else as text."""
    fields: dict[str, T.DataType | dict[str, str]] = {}
    for path, kind in paths.items():
        first, _, rest = path.partition(".")
        if rest:
            fields.setdefault(first, {})[rest] = kind
        else:
            fields[first] = T.DataType.fromDDL(kind) if kind.startswith("array") else T.StringType()
    return T.StructType(
        [T.StructField(n, text_schema(kind) if isinstance(kind, dict) else kind) for n, kind in fields.items()]
    )


class PayloadReader:
    """Reads ``a.b.c`` paths from a payload held as VARIANT, STRUCT, JSON text or flat columns.

    A missing path, a JSON null and a value that does not fit the type all give
    SQL NULL.  With a VARIANT in a shredded Parquet table the paths used become
    the scan's read schema; with a STRUCT they are ordinary nested columns, and
    flat columns are named ``payload.a.b.c``.  JSON text is parsed once, for the
    ``paths`` (path, type) that will be read; without them it becomes a VARIANT.
    """

    def __init__(self, df: DataFrame, column: str = "payload", paths: Mapping[str, str] | None = None) -> None:
        self._column = column
        self._kind: T.DataType | None = df.schema[column].dataType if column in df.columns else None
        if isinstance(self._kind, T.StringType):
            self._kind = text_schema(paths) if paths else T.VariantType()
            parsed = F.from_json(column, self._kind) if paths else F.try_parse_json(F.col(column))
            df = df.withColumn(column, parsed)
        prefix = f"{column}."
        self._flat = {f.name.removeprefix(prefix): f.dataType for f in df.schema.fields if f.name.startswith(prefix)}
        if self._kind is None and not self._flat:
            raise TypeError(f"no column {column}")
        if self._kind is not None and not isinstance(self._kind, (T.VariantType, T.StructType)):
            raise TypeError(f"payload must be VARIANT, STRUCT or STRING, not {self._kind.simpleString()}")
        self.frame = df

    def expression(self, path: str, to: str) -> str:
        """SQL text that reads ``path`` as type ``to`` from :attr:`frame`."""
        if isinstance(self._kind, T.VariantType):
            return f"try_variant_get(`{self._column}`, '$.{path}', '{to}')"
        steps = path.split(".")
        if self._kind is None:
            kind, value = self._flat.get(path), f"`{self._column}.{path}`"
        else:
            kind, value = self._kind, ".".join(f"`{step}`" for step in [self._column, *steps])
            for step in steps:
                kind = kind[step].dataType if isinstance(kind, T.StructType) and step in kind.names else None
        if kind is None:
            return f"CAST(NULL AS {to})"
        return value if kind.simpleString() == to else f"try_cast({value} AS {to})"
