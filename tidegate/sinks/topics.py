"""Writing topic records and acknowledgements."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame

from tidegate.operators.ack import ACK_BATCH


Delete = Callable[[str, list[tuple[str, str]]], Iterable[str]]
"""``delete(queue_url, [(message_id, receipt_handle), ...])`` -> ids it could not delete."""


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def write_topic(records: DataFrame, root: str, batch_id: int) -> None:
    """One folder per batch, inside it one per topic. Writing a batch again
    replaces it, so a replayed micro-batch leaves no second copy."""
    records.write.mode("overwrite").partitionBy("topic").parquet(batch_path(root, batch_id))


def write_kafka(records: DataFrame, servers: str, **options: str) -> None:
    """The same records to Kafka, where its connector is on the class path."""
    out = records.select("topic", "partition", "key", "value", "headers")
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()


def append_ledger(ledger: DataFrame, root: str, batch_id: int) -> None:
    ledger.write.mode("overwrite").parquet(batch_path(root, batch_id))


def delete_acknowledged(ledger: DataFrame, delete: Delete) -> DataFrame:
    """Run the delete requests of a ledger on the executors, at most ten entries
    each. What could not be deleted is reported and comes again."""

    def run(batches):
        for pdf in batches:
            failed = []
            for (queue, _, _), part in pdf.groupby(["queue_url", "lane", "ack_batch"], sort=False):
                entries = list(zip(part["message_id"], part["receipt_handle"]))
                for start in range(0, len(entries), ACK_BATCH):
                    missed = delete(queue, entries[start:start + ACK_BATCH])
                    failed += [(queue, message_id) for message_id in missed]
            yield pd.DataFrame(failed, columns=["queue_url", "message_id"])

    requests = ["queue_url", "lane", "ack_batch"]
    return (
        ledger.repartition(*requests).sortWithinPartitions(*requests)
        .mapInPandas(run, "queue_url string, message_id string")
    )
