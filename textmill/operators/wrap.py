"""Give raw chunks their byte offsets in the original object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import byte_length
from textmill.operators.ordered import StreamOrder, running_sum


def _offsets(df: DataFrame, order: StreamOrder, length: Column, start: int | Column, encoding: str) -> DataFrame:
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        running_sum(df, order, length, "__before")
        .withColumn("start", (first + F.col("__before")).cast("bigint"))
        .withColumn("end", (F.col("start") + length).cast("bigint"))
        .withColumn("encoding", F.lit(encoding))
        .drop("__before")
    )


def _explicit(df: DataFrame, starts: DataFrame, order: StreamOrder, length: Column, encoding: str) -> DataFrame:
    keys = [*order.keys, order.seq]
    both = df.withColumn("__chunk", F.lit(True)).join(
        starts.select(*keys, F.col("start").cast("bigint").alias("start")), keys, "full_outer"
    )
    missing = F.col("__chunk").isNull() | F.col("start").isNull()
    return (
        both.withColumn(
            "start",
            F.when(
                missing, F.raise_error(F.lit("chunks and starts must have the same length")).cast("bigint")
            ).otherwise(F.col("start")),
        )
        .withColumn("end", (F.col("start") + length).cast("bigint"))
        .withColumn("encoding", F.lit(encoding))
        .drop("__chunk")
    )


def wrap_bytes(
    df: DataFrame, order: StreamOrder, start: int | Column = 0, encoding: str = "utf-8", data: str = "data"
) -> DataFrame:
    """Offsets of byte chunks that follow each other from ``start``."""
    return _offsets(df, order, F.octet_length(data), start, encoding)


def wrap_bytes_at(
    df: DataFrame, starts: DataFrame, order: StreamOrder, encoding: str = "utf-8", data: str = "data"
) -> DataFrame:
    """Offsets of byte chunks with one given start each; a missing partner fails the job."""
    return _explicit(df, starts, order, F.octet_length(data), encoding)


def wrap_text(
    df: DataFrame, order: StreamOrder, start: int | Column = 0, encoding: str = "utf-8", text: str = "text"
) -> DataFrame:
    """Offsets of text chunks, counted in encoded bytes from ``start``."""
    return _offsets(df, order, byte_length(F.col(text), encoding), start, encoding)


def wrap_text_at(
    df: DataFrame, starts: DataFrame, order: StreamOrder, encoding: str = "utf-8", text: str = "text"
) -> DataFrame:
    """Offsets of text chunks with one given start each; a missing partner fails the job."""
    return _explicit(df, starts, order, byte_length(F.col(text), encoding), encoding)
