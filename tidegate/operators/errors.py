"""Errors as columns: a bad message is marked and goes on, its batch never fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def track_errors(df: DataFrame) -> DataFrame:
    """Make sure the error columns and the untouched body exist."""
    missing = {
        name: F.lit(None).cast("string")
        for name in ("error_class", "error_message") if name not in df.columns
    }
    if "original_body" not in df.columns:
        missing["original_body"] = F.col("body")
    return df.withColumns(missing) if missing else df


def usable(col: Column) -> Column:
    """The column for rows still in good order, null for failed ones."""
    return F.when(F.col("error_class").isNull(), col)


def settle(df: DataFrame, result: str, target: str = "body") -> DataFrame:
    """Take over a struct of (value, error_class, error_message): the value where
    the row is in good order, else the error; an earlier error stays."""
    new_error = F.col("error_class").isNull() & F.col(f"{result}.error_class").isNotNull()
    good = F.col("error_class").isNull() & F.col(f"{result}.error_class").isNull()
    return df.withColumns(
        {
            target: F.when(good, F.col(f"{result}.value")).otherwise(F.col(target)),
            "error_class": F.when(new_error, F.col(f"{result}.error_class")).otherwise(
                F.col("error_class")
            ),
            "error_message": F.when(new_error, F.col(f"{result}.error_message")).otherwise(
                F.col("error_message")
            ),
        }
    ).drop(result)


def outcome(value: Column, error_class: Column, error_message: Column) -> Column:
    return F.struct(
        value.cast("string").alias("value"),
        error_class.cast("string").alias("error_class"),
        error_message.cast("string").alias("error_message"),
    )


