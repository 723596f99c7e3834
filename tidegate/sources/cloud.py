"""Receive and delete calls for the cloud queue service, where its client library
is installed. Not tested here: the library is not part of this environment."""

from __future__ import annotations

import datetime as dt


def _client(region: str | None):
    try:
        import boto3
    except ImportError as error:
        raise RuntimeError("install boto3 on the executors to reach live queues") from error
    return boto3.client("sqs", region_name=region)


def receiver(region: str | None = None):
    """A ``receive`` function for ``receive_messages``."""

    def receive(queue_url: str, max_messages: int, wait_seconds: int) -> list[dict]:
        answer = _client(region).receive_message(
            QueueUrl=queue_url,
            MaxNumberOfMessages=max_messages,
            WaitTimeSeconds=wait_seconds,
            AttributeNames=["All"],
            MessageAttributeNames=["All"],
        )
        now = dt.datetime.now(dt.timezone.utc)
        return [
            {
                "message_id": m["MessageId"],
                "receipt_handle": m["ReceiptHandle"],
                "body": m["Body"],
                "md5_of_body": m.get("MD5OfBody"),
                "attributes": m.get("Attributes", {}),
                "message_attributes": {
                    name: {
                        "data_type": v["DataType"],
                        "string_value": v.get("StringValue"),
                        "binary_value": v.get("BinaryValue"),
                    }
                    for name, v in m.get("MessageAttributes", {}).items()
                },
                "received_at": now,
            }
            for m in answer.get("Messages", [])
        ]

    return receive


def deleter(region: str | None = None):
    """A ``delete`` function for ``delete_acknowledged``."""

    def delete(queue_url: str, entries: list[tuple[str, str]]) -> list[str]:
        answer = _client(region).delete_message_batch(
            QueueUrl=queue_url,
            Entries=[{"Id": str(i), "ReceiptHandle": r} for i, (_, r) in enumerate(entries)],
        )
        return [entries[int(f["Id"])][0] for f in answer.get("Failed", [])]

    return delete
