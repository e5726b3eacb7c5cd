"""Mixing sources to target weights: hash order, distributed prefix sums, exact cuts.

Every document gets a random key from its id.  Within a source the documents stand in the order
of that key; the mix takes each source's budget from the front of the order and starts over when
the budget exceeds the source (an epoch).  A document's position is the sum of the sizes before
it: keys are cut into ranges, ranges are summed first, and only then rows, so that a source
holding a third of all rows is spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count

#: Ranges of the random key within a source; three hexadecimal digits of the key.
RANGES = 4096


def random_key(doc_id: Column) -> Column:
    """A key that looks random and depends on the id alone, so that reruns agree."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``target`` of each row of ``sizes (source, source_size)``, one row per source.

    Sources by code point, null last, take the weights in turn.  A target stops at ``most`` times
    the source's size and the others share the rest by weight.  With the sources in ascending
    order of limit per weight, ``level`` is what a unit of weight gets if all sources before are
    at their limits; it rises while that holds and falls afterwards, so the largest is the one
    that ends the sharing.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        (F.row_number().over(named) - 1) % len(weights) + 1,
    )
    limited = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    filling = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - full) / open_weight
    return (
        limited.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")))
        .select("source", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """How many words the mix takes of each document.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; ``keep`` names the columns that go into
    the result besides ``size``, ``source_size``, ``target`` and ``taken`` (clashing columns
    that are not kept do no harm; a kept column with one of the four names is an error).

    A null text has size 0 and a null source is a source of its own, the last one.  Repeated
    rows each count.  Documents of size 0 are never taken.  An empty table gives an empty
    result.  Every source's taken words are its target, rounded, to the word: the document on
    the cut is taken in part.
    """
    clash = {"size", "source_size", "target", "taken"} & set(keep)
    if clash:
        raise ValueError(f"cannot keep columns named like results: {sorted(clash)}")
    key = random_key(F.col("doc_id"))
    rows = docs.select(
        F.struct(*keep).alias("kept"),
        F.struct(F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("name")).alias("s"),
        key.alias("key"),
        F.substring(key, 1, 3).alias("part"),
        F.col("doc_id").alias("id"),
        word_count(F.col("text")).alias("size"),
    )
    parts = rows.groupBy("s", "part").agg(F.sum("size").alias("part_size"))
    before_part = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(before_part), F.lit(0)))
    sizes = parts.groupBy("s").agg(F.sum("part_size").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(~F.col("s.no"), F.col("s.name")))
    targets = source_targets(sizes.select("source", "source_size"), weights, most).select(
        F.struct(F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("name")).alias("s"),
        "source_size",
        "target",
    )
    offsets = parts.join(targets, "s").select("s", "part", "part_start", "source_size", "target")

    within = Window.partitionBy("s", "part").orderBy("key", "id", "size")
    placed = rows.withColumn("inner", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    start = F.col("part_start") + F.col("inner") - F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return (
        placed.join(offsets, ["s", "part"])
        .withColumn("budget", budget)
        .withColumn("epochs", epochs)
        .select(
            "kept.*",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + last).cast("long").alias("taken"),
        )
    )
