"""Decompression of whole bodies or of one field in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.jsonpath import split_path
from tidegate.functions.payload import decode_leaf, decode_text
from tidegate.operators.errors import settle, track_errors, usable


def decompress_body(
    df: DataFrame, fmt: str = "AUTO", try_base64: bool = True, path: str | None = None
) -> DataFrame:
    """Only the body changes; ids, attributes and checksum stay as received."""
    rows = track_errors(df)
    parts = split_path(path)
    body = usable(F.col("body"))
    result = decode_leaf(body, parts, fmt, try_base64) if parts else decode_text(body, fmt, try_base64)
    return settle(rows.withColumn("decoded", result), "decoded")


def decompress_safe(col: Column, fmt: str = "AUTO", try_base64: bool = True) -> Column:
    """The decompressed text, or the original where that fails."""
    return F.coalesce(decode_text(col, fmt, try_base64)["value"], col)
