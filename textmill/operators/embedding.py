"""Embedding providers and the columns that call them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import single_line, vector_id
from textmill.operators.retry import EMBED_RETRY, Retry

# Fixed value: texts per call that an embedding service accepts.
EMBED_BATCH_LIMIT = 2048

# A client embeds texts and answers with vectors in order, or with (index, vector) pairs.
Client = Callable[[list[str]], list]


@dataclass(frozen=True)
class EmbeddingProvider:
    """How to embed: ``column`` maps a text column to a vector column."""

    name: str
    dimension: int
    column: Callable[[Column], Column] = field(repr=False)
    batch_limit: int = EMBED_BATCH_LIMIT
    #: The same provider with another batch size and number of batches at a time, if it has any.
    resized: Callable[[int, int | None], EmbeddingProvider] | None = field(default=None, repr=False)

    def with_batches(self, size: int, max_concurrent: int | None = None) -> EmbeddingProvider:
        """The provider with batches of ``size`` texts; those that embed in place have none."""
        if max_concurrent is not None and max_concurrent < 1:
            raise ValueError("max_concurrent must be at least 1")
        return self.resized(size, max_concurrent) if self.resized else self


def in_input_order(answer: list, expected: int) -> list:
    """Vectors in the order of the request; a short answer is an error."""
    if answer and isinstance(answer[0], tuple):
        answer = [vector for _, vector in sorted(answer, key=lambda pair: pair[0])]
    if len(answer) != expected:
        raise ValueError(f"{expected} texts gave {len(answer)} vectors")
    return answer


def client_provider(
    name: str,
    dimension: int,
    connect: Callable[[], Client],
    batch_limit: int = EMBED_BATCH_LIMIT,
    batch_size: int | None = None,
    max_concurrent: int = 1,
    retry: Retry = EMBED_RETRY,
) -> EmbeddingProvider:
    """A provider that calls a service in batches, several at a time per task.

    Workers connect once.  A batch that still fails after its retries fails the task;
    none is left out.
    """
    if max_concurrent < 1:
        raise ValueError("max_concurrent must be at least 1")
    size = batch_size or batch_limit
    if not 1 <= size <= batch_limit:
        raise ValueError(f"batch size must lie in [1, {batch_limit}]")

    @F.pandas_udf("array<float>")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = connect()

        def embed(texts: list[str]) -> list:
            return retry.call(lambda: in_input_order(client(texts), len(texts)))

        with ThreadPoolExecutor(max_concurrent) as pool:
            for series in batches:
                texts = series.tolist()
                groups = [texts[i : i + size] for i in range(0, len(texts), size)]
                yield pd.Series([v for answer in pool.map(embed, groups) for v in answer], dtype=object)

    def resized(size: int, concurrent: int | None) -> EmbeddingProvider:
        return client_provider(name, dimension, connect, batch_limit, size, concurrent or max_concurrent, retry)

    return EmbeddingProvider(name, dimension, call, batch_limit, resized)


# Fixed value: what counts as a term of the hashed embedding.
_TERM = r"[\p{L}\p{N}]+"


def term_hash_provider(dimension: int = 64) -> EmbeddingProvider:
    """Term counts hashed to a fixed number of buckets: needs no model and no service.

    A term's bucket comes from the first 32 bits of its MD5.  Terms are cut in the JVM;
    the worker hashes each distinct term of an Arrow batch once and counts by array.
    """

    @F.arrow_udf("array<float>")
    def count(terms: pa.Array) -> pa.Array:
        coded = terms.flatten().dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        digests = b"".join(md5(term, usedforsecurity=False).digest() for term in known)
        buckets = (np.frombuffer(digests, dtype=">u4")[::4] % dimension).astype(np.int64)
        lengths = pa.compute.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(terms), dtype=np.int64), lengths)
        cells = rows * dimension + buckets[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(cells, minlength=len(terms) * dimension).astype(np.float32)
        offsets = np.arange(0, len(counts) + 1, dimension, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts))

    return EmbeddingProvider(
        f"term-hash-{dimension}",
        dimension,
        lambda text: count(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))),
    )


_PROVIDERS: dict[str, Callable[[], EmbeddingProvider]] = {
    "term-hash-64": lambda: term_hash_provider(64),
    "term-hash-1536": lambda: term_hash_provider(1536),
}


def register_provider(name: str, build: Callable[[], EmbeddingProvider]) -> None:
    """Make an embedding provider available by model name."""
    _PROVIDERS[name] = build


def get_provider(name: str) -> EmbeddingProvider:
    """The embedding provider of a model name."""
    if name not in _PROVIDERS:
        raise ValueError(f"no embedding provider is registered as {name!r}")
    return _PROVIDERS[name]()


def embed_chunks(
    chunks: DataFrame, provider: EmbeddingProvider, text: str = "text", vector: str = "vector"
) -> DataFrame:
    """Add the vector of each chunk; newlines reach the provider as spaces."""
    return chunks.withColumn(vector, provider.column(single_line(F.col(text))))


def assemble_vectors(
    chunks: DataFrame, prefix: Column | str = "object_id", metadata: Column | None = None
) -> DataFrame:
    """Stored vectors ``(id, vector[, metadata])`` of embedded chunks.

    ``prefix`` is one value for the whole stream or a column.
    """
    name = F.col(prefix) if isinstance(prefix, str) else prefix
    columns = [vector_id(name, F.col("start"), F.col("end")).alias("id"), F.col("vector")]
    if metadata is not None:
        columns.append(metadata.alias("metadata"))
    return chunks.select(*columns)
