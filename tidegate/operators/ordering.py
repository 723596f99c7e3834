"""Order inside message groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.ranking import split_row_number
from tidegate.operators.records import system_attribute


def group_id() -> Column:
    return system_attribute("MessageGroupId")


def sequence() -> Column:
    """Sequence numbers have up to 20 digits: compare them as numbers."""
    return system_attribute("SequenceNumber").try_cast("decimal(38,0)")


def fifo_order(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in (queue, group, sequence) order over range partitions: a small group
    lies in one partition, a hot group in neighbouring ones, always in order."""
    keys = ["queue_url", "group_id", "sequence"]
    ordered = df.withColumns({"group_id": group_id(), "sequence": sequence()})
    spread = (
        ordered.repartitionByRange(partitions, *keys) if partitions
        else ordered.repartitionByRange(*keys)
    )
    return spread.sortWithinPartitions(*keys)


def group_positions(df: DataFrame, span: int) -> DataFrame:
    """Position of each message in its group. ``span`` sequence numbers form one
    unit of work."""
    rows = df.withColumns({"group_id": group_id(), "sequence": sequence()})
    rows = rows.where(F.col("group_id").isNotNull())
    return split_row_number(
        rows, ["queue_url", "group_id"],
        F.floor(F.col("sequence") / F.lit(span)), ["sequence"], "position",
    )
