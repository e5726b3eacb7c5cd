"""Options of an ingest job: arguments first, then environment variables, then defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import types as T

from textmill.functions.text import PREFERRED_DELIMITERS, WORD_DELIMITERS
from textmill.functions.tokens import MAX_TOKENS, MIN_TOKENS
from textmill.schema import NO_METADATA
from textmill.sources.objects import CHUNK_SIZE, PART_SIZE, check_sizes


def _env(name: str, default: str) -> str:
    return os.environ.get(name) or default


@dataclass(frozen=True)
class IngestOptions:
    """Everything a job needs beside its input and its store."""

    bucket: str = field(default_factory=lambda: _env("UPLOAD_BUCKET_NAME", "documents"))
    embedding_model: str = field(default_factory=lambda: _env("EMBEDDING_MODEL_NAME", "term-hash-64"))
    vector_store: str = field(default_factory=lambda: _env("VECTOR_STORE_PROVIDER_NAME", "parquet"))
    dimension: int = field(default_factory=lambda: int(_env("VECTOR_DIMENSION", "64")))
    metadata: T.StructType = NO_METADATA
    part_size: int = field(default_factory=lambda: int(_env("PART_SIZE", str(PART_SIZE))))
    chunk_size: int = field(default_factory=lambda: int(_env("CHUNK_SIZE", str(CHUNK_SIZE))))
    min_tokens: int = MIN_TOKENS
    max_tokens: int = MAX_TOKENS
    tokenizer: str = "words"
    word_delimiters: str = WORD_DELIMITERS
    preferred_delimiters: str = PREFERRED_DELIMITERS
    encoding: str = "utf-8"
    on_invalid: str = "fail"
    quarantine_path: str | None = None
    #: Where a stream reports announced objects that are not there; without it they stop the stream.
    dead_letter_path: str | None = None
    #: Chunks embedded and written at a time; as many as provider and store accept if not given.
    batch_size: int | None = None
    max_concurrent: int | None = field(default_factory=lambda: int(_env("MAX_CONCURRENT_BATCHES", "0")) or None)

    def __post_init__(self):
        check_sizes(self.part_size, self.chunk_size)
        if self.batch_size is not None and self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        if self.max_concurrent is not None and self.max_concurrent < 1:
            raise ValueError("max_concurrent must be at least 1")
        if self.on_invalid not in ("fail", "quarantine"):
            raise ValueError("on_invalid must be 'fail' or 'quarantine'")

    @property
    def one_chunk(self) -> bool:
        """True when a part is never larger than a chunk, as by default."""
        return self.chunk_size >= self.part_size
