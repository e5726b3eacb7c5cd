"""Consecutive batches of an ordered stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.ordered import StreamOrder, running_sum


def effective_batch_size(requested: int | None, *limits: int) -> int:
    """The requested size, or the smallest of the clients' limits."""
    largest = min(limits)
    if requested is None:
        return largest
    if not 1 <= requested <= largest:
        raise ValueError(f"batch size must lie in [1, {largest}]")
    return requested


def number_batches(df: DataFrame, order: StreamOrder, size: int, name: str = "batch") -> DataFrame:
    """Number consecutive groups of ``size`` rows; the last one may be short."""
    if size < 1:
        raise ValueError(f"a batch cannot hold {size} rows")
    return (
        running_sum(df, order, F.lit(1), "__rank")
        .withColumn(name, F.floor(F.col("__rank") / F.lit(size)).cast("bigint"))
        .drop("__rank")
    )


def collect_batches(df: DataFrame, order: StreamOrder, size: int, columns: list[str]) -> DataFrame:
    """One row per batch with its items in order; a batch holds at most ``size`` rows."""
    item = F.struct(order.seq, *columns)
    return (
        number_batches(df, order, size)
        .groupBy(*order.keys, "batch")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
    )


def attach_per_batch(df: DataFrame, values: DataFrame, order: StreamOrder, size: int) -> DataFrame:
    """Give every row the value of its batch, one per batch in order.

    ``values`` holds ``(…stream keys, batch, …)``; a batch without a value fails the job, whichever
    of the values the job uses.
    """
    keys = [*order.keys, "batch"]
    joined = number_batches(df, order, size).join(values.withColumn("__found", F.lit(True)), keys, "left")
    given = {f.name: f.dataType for f in values.schema.fields if f.name not in order.keys}

    def checked(name: str) -> Column:
        missing = F.raise_error(F.lit("fewer values than batches")).cast(given[name])
        return F.when(F.col("__found"), F.col(name)).otherwise(missing)

    return joined.withColumns({name: checked(name) for name in given}).drop("__found")
