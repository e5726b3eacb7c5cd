"""Schemas of the data model.

A chunk stream is a DataFrame with explicit order columns: the stream (an object and the
byte at which the part starts) and the position ``seq`` inside it.  Offsets are bytes in
the original object, half open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBJECT_ID = T.StructType(
    [T.StructField("bucket", T.StringType()), T.StructField("key", T.StringType())]
)

# Wire names of a part descriptor.
PART_DESCRIPTOR = T.StructType(
    [
        T.StructField("objectId", OBJECT_ID),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)

_ORDER = [
    T.StructField("object_id", T.StringType()),
    T.StructField("part_start", T.LongType()),
    T.StructField("seq", T.LongType()),
]
_RANGE = [
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("encoding", T.StringType()),
]

ENCODED_CHUNK = T.StructType([*_ORDER, T.StructField("data", T.BinaryType()), *_RANGE])
DECODED_CHUNK = T.StructType([*_ORDER, T.StructField("text", T.StringType()), *_RANGE])

VECTOR = T.ArrayType(T.FloatType())
NO_METADATA = T.StructType([])

NOTIFICATION = T.StructType(
    [
        T.StructField("Event", T.StringType()),
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField(
                                        "object",
                                        T.StructType([T.StructField("key", T.StringType())]),
                                    )
                                ]
                            ),
                        )
                    ]
                )
            ),
        ),
    ]
)


def stored_vector(metadata: T.StructType = NO_METADATA) -> T.StructType:
    """Schema of stored vectors; without metadata fields the column is left out."""
    fields = [T.StructField("id", T.StringType(), False), T.StructField("vector", VECTOR, False)]
    if metadata.fields:
        fields.append(T.StructField("metadata", metadata))
    return T.StructType(fields)


def distinct_chunks(chunks: DataFrame, payload: str = "text") -> DataFrame:
    """One row per chunk identity: payload, start and end (the encoding does not count)."""
    return chunks.dropDuplicates([payload, "start", "end"])


def chunk_difference(left: DataFrame, right: DataFrame, payload: str = "text") -> DataFrame:
    """Chunks that only one side has, counted with multiplicity; empty when both are equal."""
    identity: list[Column] = [F.col(payload), F.col("start"), F.col("end")]
    one = left.select(*identity, F.lit(1).alias("side"))
    other = right.select(*identity, F.lit(-1).alias("side"))
    return (
        one.unionByName(other)
        .groupBy(payload, "start", "end")
        .agg(F.sum("side").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )
