"""Replace a record's value by one field of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.functions.jsonpath import compact_json, json_leaf, split_path
from tidegate.operators.errors import outcome, settle, usable


def struct_leaf(schema: T.DataType, col: Column, parts: list[str]) -> Column | None:
    """The field of a typed value as text, None when its type has no such path."""
    for name in parts:
        if not isinstance(schema, T.StructType) or name not in schema.fieldNames():
            return None
        schema, col = schema[name].dataType, col[name]
    if isinstance(schema, T.StringType):
        return col
    return F.to_json(col) if isinstance(schema, (T.StructType, T.ArrayType)) else col.cast("string")


def extract_field(
    df: DataFrame, path: str | None, fail_on_missing: bool = False, column: str = "value"
) -> DataFrame:
    """Text leaves come raw, others as JSON text. A missing path or a value that is
    not JSON leaves the value, or fails the row if asked to."""
    parts = split_path(path)
    if not parts:
        return df
    rows = df if "error_class" in df.columns else df.withColumns(
        {n: F.lit(None).cast("string") for n in ("error_class", "error_message")}
    )
    schema = df.schema[column].dataType
    value = F.col(column)
    if isinstance(schema, T.StructType):
        leaf = struct_leaf(schema, value, parts)
        found = F.lit(None).cast("string") if leaf is None else leaf
        text, broken = F.to_json(value), F.lit(False)
    else:
        found, text = json_leaf(usable(value), parts), value
        broken = compact_json(value).isNull()
    rows = rows.withColumns({"found": found, column: text})
    kept = F.coalesce(F.col("found"), F.col(column))
    if not fail_on_missing:
        return rows.withColumn(column, kept).drop("found")
    # Null and empty values have nothing to miss.
    failed = F.coalesce(
        F.col("found").isNull() & (F.col(column) != "") & F.col("error_class").isNull(), F.lit(False)
    )
    result = outcome(
        kept,
        F.when(failed & broken, "JsonError").when(failed, "FieldMissing"),
        F.when(failed & broken, "Invalid JSON in message").when(
            failed, f"Field path '{path}' not found in message"
        ),
    )
    return settle(rows.withColumn("extracted", result), "extracted", column).drop("found")
