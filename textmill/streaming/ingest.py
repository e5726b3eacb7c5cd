"""Incremental ingest: new files, or new rows, become vectors as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill.operators.embedding import EmbeddingProvider
from textmill.plans.ingest import check_metadata_values, check_quarantine, embed_and_upsert, prepare_parts, report_quarantined
from textmill.plans.options import IngestOptions
from textmill.session import materialize
from textmill.sinks.vectors import VectorStore
from textmill.sources.notifications import parse_notifications
from textmill.sources.objects import object_metadata, plan_parts, read_ranges, stat_objects

_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_objects(spark: SparkSession, path: str, bucket: str | None = None, **options: str) -> DataFrame:
    """New files of a folder as a stream of object metadata; contents stay unread."""
    files = spark.readStream.format("binaryFile").schema(_BINARY_FILE).options(**options).load(path)
    return object_metadata(files, path, bucket)


def arriving_notifications(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Upload notifications, one JSON message per line of the files that arrive: ``(body)``."""
    return spark.readStream.options(**options).text(path).select(F.col("value").alias("body"))


def parts_of_notified(
    messages: DataFrame, root: str, options: IngestOptions, all_records: bool = False, url_decode: bool = False
) -> DataFrame:
    """Parts of the objects that one micro-batch of notifications names.

    Objects announced more than once are read once, and each is asked for its size once.  With
    ``dead_letter_path`` those that are missing are reported there, ``(object_id, path, at)``, and
    the others go on; a micro-batch that runs again may report them again.
    """
    named = parse_notifications(messages, options.bucket, "body", all_records, url_decode).dropDuplicates(["object_id"])
    found = materialize(stat_objects(named, root, "null" if options.dead_letter_path else "fail"))
    if options.dead_letter_path:
        lost = found.filter("length IS NULL")
        if not lost.isEmpty():
            lost.select("object_id", "path", F.current_timestamp().alias("at")).write.mode("append").parquet(options.dead_letter_path)
        found = found.filter("length IS NOT NULL")
    return read_ranges(plan_parts(found, options.part_size))


def parts_of_arriving(objects: DataFrame, options: IngestOptions) -> DataFrame:
    """Parts of one micro-batch of objects, read by byte range."""
    return read_ranges(plan_parts(objects, options.part_size))


def start_ingest(
    source: DataFrame,
    to_parts: Callable[[DataFrame], DataFrame],
    store: VectorStore,
    provider: EmbeddingProvider,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
    available_now: bool = True,
    prefix: Column | str = "object_id",
    metadata: Column | None = None,
) -> StreamingQuery:
    """Start the ingest stream.

    ``prefix`` and ``metadata`` are columns over the finished chunks, as for ``ingest_files``.

    A micro-batch that runs again after a failure writes the same ids with the same
    vectors, so delivery at least once is enough.  With ``on_invalid="quarantine"`` each
    micro-batch reports the parts it leaves out in its own folder below ``quarantine_path``.
    """
    check_quarantine(options)
    check_metadata_values(options, metadata)

    def write(batch: DataFrame, number: int) -> None:
        parts = to_parts(batch)
        report_quarantined(parts, options, str(number))
        embed_and_upsert(
            prepare_parts(parts, options),
            store,
            provider,
            prefix,
            metadata,
            batch_size=options.batch_size,
            max_concurrent=options.max_concurrent,
        )

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
