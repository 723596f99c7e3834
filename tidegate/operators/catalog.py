"""Versioned schemas per subject, kept as a table.

Columns: subject, version, schema_id, profile, schema_json, fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.ranking import split_row_number


def subject_name(topic: Column, is_key: bool = False) -> Column:
    return F.concat(topic, F.lit("-key" if is_key else "-value"))


def fingerprint(profile: Column, schema_json: Column) -> Column:
    return F.md5(F.concat_ws("\n", profile, schema_json))


def schema_id_of(print_: Column) -> Column:
    """Id of a schema: the same text gets the same id under every subject, and no
    counter is shared between tasks."""
    return F.conv(F.substring(print_, 1, 12), 16, 10).cast("bigint")


def register_schemas(catalog: DataFrame, candidates: DataFrame) -> DataFrame:
    """New catalog rows for (subject, profile, schema_json) not yet in it. Versions
    go on from the subject's highest."""
    fresh = (
        candidates.select("subject", "profile", "schema_json").distinct()
        .withColumn("fingerprint", fingerprint(F.col("profile"), F.col("schema_json")))
        .join(catalog.select("subject", "fingerprint"), ["subject", "fingerprint"], "left_anti")
    )
    top = catalog.groupBy("subject").agg(F.max("version").alias("top"))
    numbered = split_row_number(
        fresh, ["subject"], F.substring("fingerprint", 1, 2), ["fingerprint"], "step"
    )
    return numbered.join(top, "subject", "left").select(
        "subject",
        (F.coalesce("top", F.lit(0)) + F.col("step")).cast("bigint").alias("version"),
        schema_id_of(F.col("fingerprint")).alias("schema_id"),
        "profile", "schema_json", "fingerprint",
    )


def latest_schemas(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("subject").agg(
        F.max("version").alias("version"),
        F.max_by("schema_id", "version").alias("schema_id"),
        F.max_by("schema_json", "version").alias("schema_json"),
    )


def schema_by_id(catalog: DataFrame, schema_id: int) -> DataFrame:
    return catalog.where(F.col("schema_id") == schema_id)
