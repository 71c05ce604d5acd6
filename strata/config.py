"""Table declarations and defaults for the silver step.

The configuration has the JSON shape::

    {"defaults": {"null_value": "NULL",
                  "timestamp_format": "yyyy-MM-dd HH:mm:ss",
                  "timestamp_columns": ["created_at"],
                  "drop_duplicates": true},
     "tables": {"orders": {"primary_key": "order_id",
                           "columns": {"order_id": "int", "created_at": "string"},
                           "options": {"multiLine": "true"}}}}

``csv_options`` in ``defaults`` and ``options`` per table are passed to
Spark's CSV reader (per-table values win).

A table that is not declared (or declares no columns) gets an inferred
schema; a table without a declared key uses its first column as the key.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The closed list of type names a declaration may use.
TYPE_NAMES = {
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "boolean": BooleanType(),
}


@dataclass(frozen=True)
class Defaults:
    """Settings shared by every table of the silver step."""
    null_value: str = "NULL"
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    timestamp_columns: tuple[str, ...] = ("created_at",)
    drop_duplicates: bool = True
    # Extra CSV reader options for every table (e.g. multiLine, escape);
    # Spark's CSV defaults otherwise.
    csv_options: tuple[tuple[str, str], ...] = ()

    @classmethod
    def from_dict(cls, d: Mapping | None) -> Defaults:
        d = dict(d or {})
        if "timestamp_columns" in d:
            d["timestamp_columns"] = tuple(d["timestamp_columns"])
        if "csv_options" in d:
            d["csv_options"] = tuple((d["csv_options"] or {}).items())
        return cls(**{k: v for k, v in d.items() if k in cls.__dataclass_fields__})


@dataclass(frozen=True)
class TableSpec:
    """Declared columns (ordered ``(name, type)`` pairs) and key, both
    optional."""

    columns: tuple[tuple[str, str], ...] = ()
    primary_key: str | None = None
    # CSV reader options for this table, over the defaults' ones.
    options: tuple[tuple[str, str], ...] = ()

    @classmethod
    def from_dict(cls, d: Mapping | None) -> TableSpec:
        d = d or {}
        return cls(
            tuple((d.get("columns") or {}).items()),
            d.get("primary_key"),
            tuple((d.get("options") or {}).items()),
        )

    @property
    def declared(self) -> bool:
        return bool(self.columns)

    def schema(self) -> StructType | None:
        return to_struct_type(self.columns) if self.columns else None


@dataclass(frozen=True)
class Config:
    """Defaults plus the declared tables, by table name."""
    defaults: Defaults = field(default_factory=Defaults)
    tables: Mapping[str, TableSpec] = field(default_factory=dict)

    def spec(self, table: str) -> TableSpec:
        return self.tables.get(table) or TableSpec()

    @classmethod
    def from_dict(cls, d: Mapping | None) -> Config:
        d = d or {}
        tables = {name: TableSpec.from_dict(t) for name, t in (d.get("tables") or {}).items()}
        return cls(Defaults.from_dict(d.get("defaults")), tables)

    @classmethod
    def load(cls, path: str) -> Config:
        with open(path, encoding="utf-8") as fh:
            return cls.from_dict(json.load(fh))


def to_struct_type(columns) -> StructType:
    """Ordered ``{column: type name}`` (or pairs) -> nullable StructType.

    An unknown type name raises ``KeyError`` naming the column.
    """
    items = columns.items() if isinstance(columns, Mapping) else columns
    fields = []
    for name, type_name in items:
        if type_name not in TYPE_NAMES:
            raise KeyError(
                f"column {name!r}: unknown type {type_name!r}; expected one of {sorted(TYPE_NAMES)}"
            )
        fields.append(StructField(name, TYPE_NAMES[type_name], True))
    return StructType(fields)
