"""Nested payload documents to flat, typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.values import epoch_ms
from adloom.schemas import EPOCH_MS_COLUMNS, doc_schema


def explode_docs(payloads: DataFrame) -> DataFrame:
    """One row per document. A payload without documents gives no row."""
    carried = [c for c in payloads.columns if c not in ("docs", "metadata")]
    return payloads.select(F.explode("docs").alias("doc"), *carried)


def flatten_exprs(schema: T.StructType, root: str = "doc") -> list[Column]:
    """Typed projection for every field of a document shape.

    Scalars and lists keep their name, a struct's fields become ``name_field``,
    epoch milliseconds become timestamps, and ``id`` becomes a number.
    """
    out = []
    for field in schema.fields:
        col = F.col(root)[field.name]
        if isinstance(field.dataType, T.StructType):
            out += [col[sub.name].alias(f"{field.name}_{sub.name}") for sub in field.dataType.fields]
        elif field.name in EPOCH_MS_COLUMNS and isinstance(field.dataType, T.LongType):
            out.append(epoch_ms(col).alias(field.name))
        elif field.name == "id":
            out.append(col.try_cast("bigint").alias("id"))
        else:
            out.append(col.alias(field.name.lower()))
    return out


def flatten_category(docs: DataFrame, category: str) -> DataFrame:
    carried = [c for c in docs.columns if c != "doc"]
    return docs.select(*flatten_exprs(doc_schema(category)), *carried)


def variant_exprs(schema: T.StructType, root: str = "doc") -> list[Column]:
    """The same projection over a VARIANT document, which also reads numbers
    that arrive as text. Wrong values become NULL."""
    out = []

    def read(path: str, dtype: T.DataType) -> Column:
        return F.try_variant_get(F.col(root), path, dtype.simpleString())

    for field in schema.fields:
        path = f"$.{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += [
                read(f"{path}.{sub.name}", sub.dataType).alias(f"{field.name}_{sub.name}")
                for sub in field.dataType.fields
            ]
        elif field.name in EPOCH_MS_COLUMNS and isinstance(field.dataType, T.LongType):
            out.append(epoch_ms(read(path, field.dataType)).alias(field.name))
        elif field.name == "id":
            out.append(read(path, T.LongType()).alias("id"))
        else:
            out.append(read(path, field.dataType).alias(field.name.lower()))
    return out


def structure_to_schema(structure: dict) -> T.StructType:
    """A recorded JSON structure (field -> type name, nested dict, or one-element
    list) as a Spark schema. A list whose element type is unknown holds text."""
    # Type names of the recorded structures.
    names = {
        "VARCHAR": T.StringType(),
        "NULL": T.StringType(),
        "UBIGINT": T.LongType(),
        "BIGINT": T.LongType(),
        "DOUBLE": T.DoubleType(),
        "BOOLEAN": T.BooleanType(),
    }

    def convert(shape) -> T.DataType:
        if isinstance(shape, dict):
            return T.StructType([T.StructField(k, convert(v)) for k, v in shape.items()])
        if isinstance(shape, list):
            return T.ArrayType(convert(shape[0]))
        if shape not in names:
            raise ValueError(f"unknown type in structure: {shape}")
        return names[shape]

    return convert(structure)


def discover_structure(docs: DataFrame, json_col: str) -> DataFrame:
    """One merged shape over all documents, as a schema string."""
    return docs.agg(F.schema_of_variant_agg(F.parse_json(json_col)).alias("structure"))


def expand_struct(df: DataFrame, column: str, drop: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Every key of a struct or map column as ``column_key``.

    A struct's keys come from the schema. A map's keys come from ``keys`` or from
    the data. A missing column is no error.
    """
    if column not in df.columns:
        return df
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StructType):
        names = keys if keys is not None else dtype.fieldNames()
        picked = {k: F.col(column)[k] if k in dtype.fieldNames() else F.lit(None) for k in names}
    elif isinstance(dtype, T.MapType):
        names = keys if keys is not None else distinct_keys(df, column)
        picked = {k: F.try_element_at(F.col(column), F.lit(k)) for k in names}
    else:
        # Not a dict: nothing to take keys from.
        picked = {k: F.lit(None) for k in keys or []}
    df = df.select("*", *[value.alias(f"{column}_{key}") for key, value in picked.items()])
    return df.drop(column) if drop else df


def distinct_keys(df: DataFrame, column: str) -> list[str]:
    """Every key of a map column, sorted; they become column names, so the driver has to
    hold them whatever their number."""
    found = df.select(F.explode(F.map_keys(column)).alias("key")).distinct().collect()
    return sorted(row.key for row in found)


def extract_key(df: DataFrame, new_column: str, column: str, key: str) -> DataFrame:
    """One nested key as a column; NULL when the source column is missing."""
    if column not in df.columns:
        return df.withColumn(new_column, F.lit(None).cast("string"))
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StructType):
        value = F.col(column)[key] if key in dtype.fieldNames() else F.lit(None).cast("string")
    else:
        value = F.try_element_at(F.col(column), F.lit(key))
    return df.withColumn(new_column, value)


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add the columns that are missing, as typed NULLs."""
    missing = {name: F.lit(None).cast(dtype) for name, dtype in wanted.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
