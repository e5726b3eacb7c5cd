"""Upload notifications and part descriptors as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.schema import NOTIFICATION, PART_DESCRIPTOR

_TEST_EVENT = "s3:TestEvent"


def parse_notifications(
    messages: DataFrame,
    bucket: str,
    body: str = "body",
    all_records: bool = False,
    url_decode: bool = False,
) -> DataFrame:
    """Object keys of upload notifications: ``(bucket, key, object_id)``.

    Test events are skipped.  Only the first record of a message counts unless
    ``all_records``; the bucket is the configured one, not the one in the event.  A message
    that is no JSON, has no records or has a record without a key fails the job.
    """
    event = F.from_json(F.col(body), NOTIFICATION)
    parsed = messages.select(event.alias("event")).filter(
        F.col("event.Event").isNull() | (F.col("event.Event") != _TEST_EVENT)
    )
    keys = F.col("event.Records.s3.object.key")
    key = F.explode_outer(keys) if all_records else F.get(keys, F.lit(0))
    found = parsed.select(key.alias("key"))
    if url_decode:
        found = found.withColumn("key", F.url_decode("key"))
    checked = F.when(F.col("key").isNull(), F.raise_error(F.lit("notification without an object key"))).otherwise(
        F.col("key")
    )
    return found.select(F.lit(bucket).alias("bucket"), checked.alias("key")).withColumn(
        "object_id", F.concat_ws("/", "bucket", "key")
    )


def _quoted(text: Column) -> Column:
    """A string as a JSON string: the only element of a JSON array, without the brackets."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def describe_part(bucket: Column, key: Column, start: Column, end: Column, wire: bool = False) -> Column:
    """A part descriptor as JSON; ``wire=True`` encodes the JSON once more, as a string."""
    text = F.to_json(
        F.struct(
            F.struct(bucket.alias("bucket"), key.alias("key")).alias("objectId"),
            start.cast("bigint").alias("start"),
            end.cast("bigint").alias("end"),
        )
    )
    return _quoted(text) if wire else text


def parse_part(body: Column, wire: bool = False) -> Column:
    """The struct of a part descriptor."""
    if wire:
        body = F.get(F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>"), F.lit(0))
    return F.from_json(body, PART_DESCRIPTOR)
