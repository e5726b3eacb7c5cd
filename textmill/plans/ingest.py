"""The ingest job: parts to chunks to vectors.

A part never meets another one on the way to its vectors, so all of its steps happen
inside its row: the scan, the cutting and the embedding are one stage without a shuffle.
The first shuffle is the one that writes vectors by bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.tokens import get_tokenizer, resize_array
from textmill.operators.batching import attach_per_batch, effective_batch_size
from textmill.operators.decode import check_encoding, decode_array, decode_one
from textmill.operators.embedding import EmbeddingProvider, assemble_vectors, embed_chunks, get_provider
from textmill.operators.ordered import PART_ORDER, StreamOrder, explode_rows
from textmill.operators.words import heal_array
from textmill.plans.options import IngestOptions
from textmill.sinks.vectors import VectorStore, get_store
from textmill.sources.objects import chunk_array, cut_parts, list_objects, plan_parts, read_ranges


def decode_parts(parts: DataFrame, options: IngestOptions) -> DataFrame:
    """Parts ``(object_id, start, end, data)`` with their decoded chunks as an array."""
    check_encoding(options.encoding)
    policy = "fail" if options.on_invalid == "fail" else "null"
    if options.one_chunk:
        fits = F.octet_length("data") <= options.chunk_size
        oversize = F.raise_error(F.lit("part is larger than part_size")).cast("binary")
        decoded = decode_one(F.when(fits, F.col("data")).otherwise(oversize), F.col("start"), policy)
    else:
        decoded = decode_array(chunk_array(options.chunk_size), policy)
    return parts.select(
        "object_id",
        F.col("start").alias("part_start"),
        F.col("end").alias("part_end"),
        decoded.alias("decoded"),
    )


def _undecodable() -> Column:
    return F.exists("decoded", lambda c: c["text"].isNull())


def quarantined_parts(parts: DataFrame, options: IngestOptions) -> DataFrame:
    """The ranges of parts that hold bytes outside the encoding."""
    decoded = decode_parts(parts, options)
    return decoded.filter(_undecodable()).select("object_id", "part_start", "part_end")


def check_quarantine(options: IngestOptions) -> None:
    """A job that leaves parts out must say where it reports them."""
    if options.on_invalid == "quarantine" and not options.quarantine_path:
        raise ValueError("on_invalid='quarantine' needs a quarantine_path for the parts left out")


def report_quarantined(parts: DataFrame, options: IngestOptions, attempt: str) -> None:
    """Write the ranges of undecodable parts below ``quarantine_path``, a folder per ``attempt``.

    Nothing happens unless the policy is quarantine.  An attempt that runs again replaces
    its own report.
    """
    if options.on_invalid == "quarantine":
        folder = f"{options.quarantine_path.rstrip('/')}/job={attempt}"
        quarantined_parts(parts, options).write.mode("overwrite").parquet(folder)


def prepare_parts(parts: DataFrame, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Finished chunks ``(object_id, part_start, seq, text, start, end, encoding)`` of parts."""
    decoded = decode_parts(parts, options)
    if options.on_invalid == "quarantine":
        decoded = decoded.filter(~_undecodable())
    healed = decoded.select("object_id", "part_start", heal_array(F.col("decoded"), options.word_delimiters).alias("healed"))
    resized = resize_array(
        F.col("healed"),
        get_tokenizer(options.tokenizer),
        options.min_tokens,
        options.max_tokens,
        options.preferred_delimiters,
        at_most_one=options.one_chunk,
    )
    return explode_rows(healed, ["object_id", "part_start"], resized, "seq", "chunk").select(
        "object_id",
        "part_start",
        F.col("seq").cast("bigint").alias("seq"),
        "chunk.text",
        "chunk.start",
        "chunk.end",
        F.lit(options.encoding).alias("encoding"),
    )


def vectors_of(
    chunks: DataFrame,
    provider: EmbeddingProvider,
    prefix: Column | str = "object_id",
    metadata: Column | None = None,
) -> DataFrame:
    """Stored vectors of finished chunks."""
    return assemble_vectors(embed_chunks(chunks, provider), prefix, metadata)


def embed_and_upsert(
    chunks: DataFrame,
    store: VectorStore,
    provider: EmbeddingProvider,
    prefix: Column | str = "object_id",
    metadata: Column | None = None,
    unique: bool = False,
    batch_size: int | None = None,
    max_concurrent: int | None = None,
    per_batch: DataFrame | None = None,
    order: StreamOrder = PART_ORDER,
    replaced: DataFrame | None = None,
) -> None:
    """Embed finished chunks and write them; a batch that cannot be written fails the job.

    ``prefix`` and ``metadata`` are constants or columns.  ``per_batch`` gives one value for each
    batch of ``batch_size`` chunks instead: the keys of ``order``, ``batch`` and ``prefix``,
    ``metadata`` or both.  Without ``batch_size`` a batch is as large as provider and store accept;
    ``max_concurrent`` batches of a task are embedded at a time.  Ids are unique when every object
    occurs once; ``unique`` then saves a shuffle.  ``replaced (prefix)`` names objects whose earlier
    vectors go unless they are written again.
    """
    size = effective_batch_size(batch_size, provider.batch_limit, getattr(store, "batch_limit", provider.batch_limit))
    provider = provider.with_batches(size, max_concurrent)
    if hasattr(store, "with_batches"):
        store = store.with_batches(size)
    if per_batch is not None:
        chunks = attach_per_batch(chunks, per_batch, order, size)
        prefix = "prefix" if "prefix" in per_batch.columns else prefix
        metadata = F.col("metadata") if "metadata" in per_batch.columns else metadata
    store.upsert(vectors_of(chunks, provider, prefix, metadata), unique=unique, replaced=replaced)


def parts_of_table(objects: DataFrame, options: IngestOptions) -> DataFrame:
    """Parts of objects held in table rows."""
    return cut_parts(objects, options.part_size)


def parts_of_files(spark: SparkSession, path: str, options: IngestOptions, **reader: str) -> DataFrame:
    """Parts of files, read by byte range."""
    return read_ranges(plan_parts(list_objects(spark, path, options.bucket, **reader), options.part_size))


def check_metadata_values(options: IngestOptions, metadata: Column | None) -> None:
    """A collection with metadata needs a value for each vector, and one without has no use for it."""
    if bool(options.metadata.fields) != (metadata is not None):
        raise ValueError("options.metadata and the metadata column go together")


def ingest_files(
    spark: SparkSession,
    path: str,
    store_path: str,
    options: IngestOptions = IngestOptions(),
    prefix: Column | str = "object_id",
    metadata: Column | None = None,
    replace: bool = False,
    **reader: str,
) -> VectorStore:
    """Files in a folder to vectors in a store; returns the store.

    ``prefix`` and ``metadata`` are columns over ``object_id``, ``part_start``, ``seq``, ``text``,
    ``start`` and ``end`` of the finished chunks.  With ``replace`` the vectors that an object had
    before and has no longer go.  With ``on_invalid="quarantine"`` the parts left out are written to
    ``quarantine_path`` before any vector is.
    """
    check_quarantine(options)
    check_metadata_values(options, metadata)
    store = get_store(options.vector_store, spark, store_path, options.dimension, options.metadata)
    objects = list_objects(spark, path, options.bucket, **reader)
    parts = read_ranges(plan_parts(objects, options.part_size))
    report_quarantined(parts, options, uuid.uuid4().hex)
    name = F.col(prefix) if isinstance(prefix, str) else prefix
    embed_and_upsert(
        prepare_parts(parts, options),
        store,
        get_provider(options.embedding_model),
        prefix,
        metadata,
        unique=True,
        batch_size=options.batch_size,
        max_concurrent=options.max_concurrent,
        replaced=objects.select(name.alias("prefix")) if replace else None,
    )
    return store
