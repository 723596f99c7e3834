"""Attribute-policy filter, its split and its counters."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.policy import compile_policy, parse_policy, policy_condition


def promoted_names(df: DataFrame) -> tuple[str, ...]:
    """Attributes that were written as columns when the messages were landed."""
    return tuple(df.schema["promoted"].dataType.fieldNames()) if "promoted" in df.columns else ()


def filter_messages(df: DataFrame, policy: str | None) -> DataFrame:
    """Messages that pass. Conditions on promoted attributes reach the file scan.

    A landing folder may hold files from before an attribute was promoted: rows without
    a stored presence are a second branch, which asks the map. Each branch's test on
    presence prunes the files of the other one."""
    promoted = promoted_names(df)
    used = [name for name in parse_policy(policy) if name in promoted]
    if not used:
        return df.where(policy_condition(policy, promoted=promoted))
    stored = reduce(and_, [F.col("promoted")[n]["present"].isNotNull() for n in used])
    older = reduce(or_, [F.col("promoted")[n]["present"].isNull() for n in used])
    return df.where(stored & policy_condition(policy, promoted=promoted, stored_only=True)).unionByName(
        df.where(older & policy_condition(policy, promoted=promoted))
    )


def flag_messages(df: DataFrame, policy: str | None, name: str = "passed") -> DataFrame:
    """Keep every row with a flag: both sides of the split from one scan."""
    return df.withColumn(name, compile_policy(policy, promoted=promoted_names(df)))


def filter_counters(df: DataFrame, policy: str | None, by: list[str] = ()) -> DataFrame:
    return (
        flag_messages(df, policy)
        .groupBy(*by)
        .agg(
            F.count_if("passed").alias("messages_passed"),
            F.count_if(~F.col("passed")).alias("messages_filtered"),
        )
    )
