"""Which messages may be deleted from their queue, in groups of ten."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

# Fixed value: most entries of one delete request.
ACK_BATCH = 10
LANES = 1024


def ack_ledger(handled: DataFrame, delete_enabled: bool = True, lanes: int = LANES) -> DataFrame:
    """(queue_url, message_id, receipt_handle, lane, ack_batch). A queue is cut
    into lanes by a hash of the message id, so that no task numbers a whole
    queue; each (queue, lane, ack_batch) is one delete request."""
    rows = handled.select("queue_url", "message_id", "receipt_handle")
    if not delete_enabled:
        rows = rows.where(F.lit(False))
    lane = F.conv(F.substring(F.md5("message_id"), 1, 8), 16, 10).cast("bigint") % lanes
    numbered = W.partitionBy("queue_url", "lane").orderBy("message_id", "receipt_handle")
    return rows.withColumn("lane", lane).withColumn(
        "ack_batch", F.floor((F.row_number().over(numbered) - 1) / ACK_BATCH)
    )


def pending(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Messages that are not acknowledged and will be delivered again."""
    acked = ledger.select("queue_url", "message_id").distinct()
    return messages.join(acked, ["queue_url", "message_id"], "left_anti")
