"""Higher-order helpers: name a value, exclusive running sums, ordered folds with output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Arrays grown one element at a time copy themselves; growing them in runs of this
# length keeps the copying linear in the number of elements.
RUN = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(items: Column) -> Column:
    count = F.ceil(F.size(items) / F.lit(RUN)).cast("int")
    numbers = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    return F.transform(numbers, lambda r: F.slice(items, r * RUN + 1, F.lit(RUN)))


def fold_with_output(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    output_type: str,
) -> Column:
    """Ordered fold over an array that also emits rows.

    ``step(state, item)`` gives ``struct(state, out)`` with ``out`` an array of
    ``output_type``; the result is ``struct(state, out)`` for the whole array.
    """

    none = F.array().cast(f"array<{output_type}>")
    empty_runs = F.array().cast(f"array<array<{output_type}>>")

    def one(acc: Column, item: Column) -> Column:
        return let(
            step(acc["state"], item),
            lambda r: F.struct(
                r["state"].alias("state"),
                F.when(F.size(r["out"]) == 0, acc["out"]).otherwise(F.concat(acc["out"], r["out"])).alias("out"),
            ),
        )

    def run(acc: Column, part: Column) -> Column:
        return let(
            F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one),
            lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")),
        )

    def fold(items: Column) -> Column:
        return F.aggregate(
            _runs(items),
            F.struct(zero.alias("state"), empty_runs.alias("out")),
            run,
            lambda acc: F.struct(acc["state"].alias("state"), F.flatten(acc["out"]).alias("out")),
        )

    return let(items, fold)


def running_starts(lengths: Column, base: Column) -> Column:
    """Exclusive running sum: element i is ``base`` plus the lengths before i."""

    def sums(at: Column, part: Column) -> Column:
        """The position ``at`` and the position after each length."""
        return F.aggregate(
            part,
            F.array(at),
            lambda acc, length: F.array_append(acc, F.try_element_at(acc, F.lit(-1)) + length),
        )

    def run(acc: Column, part: Column) -> Column:
        return let(
            sums(acc["at"], part),
            lambda s: F.struct(
                F.try_element_at(s, F.lit(-1)).alias("at"),
                F.array_append(acc["out"], F.slice(s, F.lit(1), F.size(s) - 1)).alias("out"),
            ),
        )

    start = F.struct(
        base.cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out")
    )
    return let(lengths, lambda ls: F.aggregate(_runs(ls), start, run, lambda acc: F.flatten(acc["out"])))
