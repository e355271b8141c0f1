"""Registered schemas: inference, lookup, conformance and violations."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructField, StructType

from quire.context import Context
from quire.errors import SchemaMismatchError
from quire.sources import filesystem as fsys
from quire.sources.catalogue_log import SCHEMA_TABLE, decode, encode

SCHEMA_NAMESPACE = uuid.UUID("6f1c1f7e-3d55-4c8e-9a53-0c1b2d4e5f60")

# Type changes that a registered schema accepts, none of which can change a value
# ("actual->expected"); decimals widen as long as no digit is lost.
SAFE_WIDENINGS = [
    "tinyint->smallint", "tinyint->int", "tinyint->bigint", "tinyint->float", "tinyint->double",
    "smallint->int", "smallint->bigint", "smallint->float", "smallint->double",
    "int->bigint", "int->double", "float->double", "date->timestamp_ntz",
]


def widens(actual: DataType, expected: DataType) -> bool:
    """Whether every value of ``actual`` is one of ``expected``."""
    if isinstance(actual, DecimalType) and isinstance(expected, DecimalType):
        return expected.scale >= actual.scale and expected.precision - expected.scale >= actual.precision - actual.scale
    return f"{canonical(actual)}->{canonical(expected)}" in SAFE_WIDENINGS


def as_nullable(dt: DataType) -> DataType:
    """The same type with every level nullable (T11: registered columns are nullable)."""
    if isinstance(dt, StructType):
        return StructType([StructField(f.name, as_nullable(f.dataType), True, f.metadata) for f in dt.fields])
    if isinstance(dt, ArrayType):
        return ArrayType(as_nullable(dt.elementType), True)
    if isinstance(dt, MapType):
        return MapType(dt.keyType, as_nullable(dt.valueType), True)
    return dt


def canonical(dt: DataType) -> str:
    """Type string with struct fields sorted by name, so field order is not a
    type difference (``DataFrame.to`` reorders nested fields by name)."""
    if isinstance(dt, StructType):
        inner = ",".join(f"{f.name.lower()}:{canonical(f.dataType)}" for f in sorted(dt.fields, key=lambda f: f.name.lower()))
        return f"struct<{inner}>"
    if isinstance(dt, ArrayType):
        return f"array<{canonical(dt.elementType)}>"
    if isinstance(dt, MapType):
        return f"map<{canonical(dt.keyType)},{canonical(dt.valueType)}>"
    return dt.simpleString()


def schema_id_of(schema: StructType) -> str:
    """Content id: equal schemas share one id."""
    return str(uuid.uuid5(SCHEMA_NAMESPACE, as_nullable(schema).json()))


def column_rows(schema: StructType) -> list[tuple]:
    return [(i + 1, f.name, f.dataType.simpleString(), True) for i, f in enumerate(schema.fields)]


def to_struct(schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    if isinstance(schema, str):
        return StructType.fromDDL(schema)
    raise TypeError("schema must be a StructType or a DDL string")


def _schema_path(ctx: Context, schema_id: str) -> str:
    return f"{ctx.schemas_dir}/{quote(schema_id, safe='')}.parquet"


def ensure_schema(ctx: Context, schema: StructType, schema_id: str) -> None:
    """Store ``schema`` under its id; an id that stands for another schema is an error."""
    st = as_nullable(schema)
    row = {"schema_id": schema_id, "schema_json": st.json(), "columns": [
        dict(zip(("ordinal", "column_name", "data_type", "nullable"), c)) for c in column_rows(st)]}
    path = _schema_path(ctx, schema_id)
    if fsys.exists(ctx.spark, path) or not fsys.create_new(ctx.spark, path, encode([row], SCHEMA_TABLE)):
        if lookup_schema(ctx, schema_id) != st:
            raise SchemaMismatchError(f"schema id {schema_id} stands for another schema")


def register_schema(ctx: Context, schema: StructType | str, schema_id: str | None = None) -> str:
    """Register a schema (all columns nullable); returns its id. An id keeps its schema."""
    st = as_nullable(to_struct(schema))
    if not st.fields:
        raise ValueError("a schema needs at least one column")
    sid = str(schema_id or schema_id_of(st))
    ensure_schema(ctx, st, sid)
    return sid


def lookup_schema(ctx: Context, schema_id: str) -> StructType:
    path = _schema_path(ctx, str(schema_id))
    if not fsys.exists(ctx.spark, path):
        raise SchemaMismatchError(f"unknown schema id {schema_id}")
    return StructType.fromJson(json.loads(decode(fsys.read_bytes(ctx.spark, path), SCHEMA_TABLE)[0]["schema_json"]))


def problems(actual: StructType, expected: StructType) -> list[tuple]:
    """(column, problem, expected type, actual type) for a frame schema against a
    registered one: ``missing``, ``extra`` or ``type``. Widenings without loss and nested
    field order are no problem."""
    have = {f.name.lower(): f for f in actual.fields}
    want = {f.name.lower(): f for f in expected.fields}
    out = []
    for k, e in want.items():
        a = have.get(k)
        if a is None:
            out.append((e.name, "missing", e.dataType.simpleString(), None))
        elif canonical(a.dataType) != canonical(e.dataType) and not widens(a.dataType, e.dataType):
            out.append((e.name, "type", e.dataType.simpleString(), a.dataType.simpleString()))
    return out + [(a.name, "extra", None, a.dataType.simpleString()) for k, a in have.items() if k not in want]


def schema_violations(ctx: Context, df: DataFrame, schema_id: str) -> DataFrame:
    """(column_name, problem, expected_type, actual_type, n_values): columns that do not fit, and how
    many values of theirs stand in the way: of a column with another type those that don't
    convert, of an extra column those that would be lost. One scan of ``df``, of these columns only."""
    found = problems(df.schema, lookup_schema(ctx, schema_id))
    rows = ctx.spark.createDataFrame(found, "column_name string, problem string, expected_type string, actual_type string")
    counts = []
    for name, problem, expected, _ in found:
        c = F.col(f"`{name}`")
        if problem == "missing":
            continue
        bad = c.isNotNull() if problem == "extra" else c.isNotNull() & c.try_cast(expected).isNull()
        counts.append(F.struct(F.lit(name).alias("column_name"), F.count(F.when(bad, 1)).alias("n_values")))
    if not counts:
        return rows.withColumn("n_values", F.lit(None).cast("long"))
    values = df.agg(F.array(*counts).alias("v")).select(F.explode("v").alias("v")).select("v.*")
    return rows.join(values, "column_name", "left")


def blocking(actual: StructType, expected: StructType) -> list[tuple]:
    """Problems that forbid publishing under ``expected``: extra columns (``to``
    would drop them silently) and types that do not widen."""
    return [p for p in problems(actual, expected) if p[1] != "missing"]


def conform(ctx: Context, df: DataFrame, schema_id: str) -> DataFrame:
    """``df`` reshaped to a registered schema: columns reordered by name (also
    inside structs), widenings applied, missing columns null."""
    target = lookup_schema(ctx, schema_id)
    if bad := blocking(df.schema, target):
        raise SchemaMismatchError(f"frame does not conform to schema {schema_id}: {bad}")
    return df.to(target)
