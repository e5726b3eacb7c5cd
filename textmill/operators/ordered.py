"""Ordered operators over streams of any length.

A window over a whole stream puts the stream into one task.  Positions are integers, so
``seq`` cut into ranges gives blocks of bounded size whatever the stream: windows run
per block, and one small row per block carries what the next block needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import materialize

_BLOCK = "__block"
_LAST = 1 << 62


@dataclass(frozen=True)
class StreamOrder:
    """The columns that order a chunk stream.

    ``block_rows`` bounds the rows that one task sorts together, and ``fold_rows`` those
    that a fold gathers into one row; set the latter so that as many chunks fit well
    into a task's memory.  ``block_rows=None`` declares that streams are bounded
    already, as those of one byte-range part are.
    """

    keys: tuple[str, ...] = ("object_id", "part_start")
    seq: str = "seq"
    block_rows: int | None = 4096
    fold_rows: int = 64

    def rows(self, *extra: str):
        return Window.partitionBy(*self.keys, *extra).orderBy(self.seq)

    def ranges(self, rows: int) -> Column:
        seq = F.col(self.seq).cast("bigint")
        return F.call_function("div", seq - F.pmod(seq, F.lit(rows)), F.lit(rows))

    def of_blocks(self, block: str) -> StreamOrder:
        """The order of the per-block rows, which form a stream of their own."""
        return replace(self, seq=block)


PART_ORDER = StreamOrder(block_rows=None)

# Blocks of blocks: the one window without a bound sees a stream's rows divided by
# block_rows once per level and once more.
_LEVELS = 2


#: Stream and block in one value, which is never null whatever the names of streams.
_AT = "__at"


def _at(order: StreamOrder, block: Column) -> Column:
    return F.struct(*order.keys, block.alias("block")).alias(_AT)


def shared_blocks(df: DataFrame, order: StreamOrder, **more: Column) -> DataFrame:
    """``df`` dealt by stream and block (``__at``), with ``more`` columns; all readers share one shuffle.

    Readers that need some of the columns only would have the optimizer plan a shuffle of those
    for each.  Rows therefore travel as one value, an element that no rule looks into, which is the
    same for all readers.
    """
    columns = [F.col(f"`{c}`") for c in df.columns] + [value.alias(name) for name, value in more.items()]
    at = _at(order, order.ranges(order.block_rows))
    dealt = df.select(at, F.array(F.struct(*columns)).alias("__row")).repartition(_AT)
    opened = dealt.withColumn("__row", F.try_element_at("__row", F.lit(1)))
    return opened.select(_AT, *[F.col(f"__row.`{c}`").alias(c) for c in (*df.columns, *more)])


def _summaries(rows: DataFrame, order: StreamOrder, *values: Column) -> DataFrame:
    """One row per block with its summary, as a stream of its own."""
    return rows.groupBy(_AT).agg(*values).select(f"{_AT}.*", "*").drop(_AT)


def _beside(rows: DataFrame, found: DataFrame, order: StreamOrder, *names: str) -> DataFrame:
    """``rows`` with what was found for their block; they stay where they are.

    Every block is found.  An outer join is one that never broadcasts the rows.
    """
    return rows.join(found.select(_at(order, F.col("block")), *names), _AT, "left")


def scan(
    df: DataFrame,
    order: StreamOrder,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    levels: int = _LEVELS,
) -> DataFrame:
    """Add, for every row, sums over the rows before it (0 for the first) and values of the row before.

    All of them come from one shuffle: a block's summary has the total of each sum and the last of
    each value, summaries are scanned as a stream of their own, and rows are completed from that
    of the blocks before theirs.
    """
    sums, lasts = sums or {}, lasts or {}

    def before(value: Column, window) -> Column:
        return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    if order.block_rows is None or levels == 0:
        window = order.rows()
        return df.withColumns(
            {name: before(value, window) for name, value in sums.items()}
            | {name: F.lag(value).over(window) for name, value in lasts.items()}
        )
    held = {name: f"__{name}{levels}" for name in (*sums, *lasts)}
    base = {name: f"{held[name]}_base" for name in held}
    rows = shared_blocks(df, order, **{held[name]: value for name, value in (*sums.items(), *lasts.items())})
    summaries = _summaries(
        rows,
        order,
        *[F.sum(held[name]).alias(held[name]) for name in sums],
        *[F.max_by(held[name], order.seq).alias(held[name]) for name in lasts],
    )
    bases = scan(
        summaries,
        order.of_blocks("block"),
        {base[name]: F.col(held[name]) for name in sums},
        {base[name]: F.col(held[name]) for name in lasts},
        levels - 1,
    )
    window = Window.partitionBy(_AT).orderBy(order.seq)
    found = {name: F.col(base[name]) + before(F.col(held[name]), window) for name in sums}
    for name in lasts:
        first = F.row_number().over(window) == 1
        found[name] = F.when(first, F.col(base[name])).otherwise(F.lag(held[name]).over(window))
    placed = _beside(rows, bases, order, *base.values())
    return placed.select(*df.columns, *[value.alias(name) for name, value in found.items()])


def running_sum(
    df: DataFrame, order: StreamOrder, value: Column, name: str, levels: int = _LEVELS
) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one (0 for the first)."""
    return scan(df, order, sums={name: value}, levels=levels)


def previous_row(
    df: DataFrame, order: StreamOrder, value: Column, name: str, levels: int = _LEVELS
) -> DataFrame:
    """Add ``value`` of the row before this one (NULL for the first of the stream)."""
    return scan(df, order, lasts={name: value}, levels=levels)


def count_breaks(df: DataFrame, order: StreamOrder, start: str, end: str, name: str) -> DataFrame:
    """Add how many rows up to this one do not start where the row before ends; the first is expected at 0.

    A block's summary is where it starts and ends and how many breaks are inside it.
    """

    def breaks(at: Column, expected: Column) -> Column:
        return F.when(at == F.coalesce(expected, F.lit(0)), 0).otherwise(1).cast("bigint")

    if order.block_rows is None:
        window = order.rows()
        broken = df.withColumn("__break", breaks(F.col(start), F.lag(end).over(window)))
        return broken.withColumn(name, F.sum("__break").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("__break")
    window = Window.partitionBy(_AT).orderBy(order.seq)
    rows = shared_blocks(df, order)
    # The first row of a block is judged by the block before.
    inside = F.when(F.row_number().over(window) == 1, 0).otherwise(breaks(F.col(start), F.lag(end).over(window)))
    rows = rows.withColumn("__inside", inside.cast("bigint"))
    summaries = _summaries(
        rows,
        order,
        F.min_by(start, order.seq).alias("__start"),
        F.max_by(end, order.seq).alias("__end"),
        F.sum("__inside").alias("__n"),
    )
    of_blocks = order.of_blocks("block")
    linked = scan(summaries, of_blocks, lasts={"__expected": F.col("__end")}, levels=_LEVELS - 1)
    linked = linked.withColumn("__first", breaks(F.col("__start"), F.col("__expected")))
    bases = scan(linked, of_blocks, sums={"__before": F.col("__first") + F.col("__n")}, levels=_LEVELS - 1)
    bases = bases.withColumn("__base", F.col("__before") + F.col("__first"))
    running = F.sum("__inside").over(window.rowsBetween(Window.unboundedPreceding, 0))
    return _beside(rows, bases, order, "__base").select(*df.columns, (F.col("__base") + running).alias(name))


def explode_rows(df: DataFrame, keep: list[str], items: Column, at: str, row: str) -> DataFrame:
    """One row per element of an expensive array expression.

    The inner form of explode makes the optimizer test the array for emptiness in a
    filter of its own, which evaluates the expression twice; the outer form does not.
    """
    return df.select(*keep, F.posexplode_outer(items).alias(at, row)).filter(F.col(at).isNotNull())


def fold_stream(
    df: DataFrame,
    order: StreamOrder,
    payload: list[str],
    zero: Column,
    fold: Callable[[Column, Column], Column],
    probe: Callable[[Column, Column], Column] | None = None,
    guess: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Run an ordered fold over each stream and return its emitted rows.

    ``fold(chunks, state)`` gives ``struct(state, out)``.  Rows come back with the
    stream keys, a new ``seq`` from 0 without holes and the fields of ``out``.

    Blocks of a long stream run side by side.  Every block is folded from a guessed
    state, then from each state its predecessor was seen to end in, until no block ends
    in a state its successor has not been folded from; following those results from the
    first block gives the true states.  The result is exact.  Texts whose cuts fall in
    step again soon need two rounds, and no text more than there are states a boundary
    can have, however many blocks there are.

    ``guess(first chunk)`` is the state to start from, ``zero`` if not given.  ``probe``
    is the fold for those rounds where ``fold`` may fail: a wrong guess must not.
    """
    keys = list(order.keys)
    item = F.struct(order.seq, *payload)

    def rows(folded: DataFrame) -> DataFrame:
        """Emitted rows; positions go on from ``__base``."""
        emitted = explode_rows(folded, [*keys, "__base"], F.col("__fold.out"), "__at", "__row")
        return emitted.select(*keys, (F.col("__base") + F.col("__at")).alias(order.seq), "__row.*")

    start = F.lit(0).cast("bigint").alias("__base")
    if order.block_rows is None:
        whole = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("__chunks"))
        return rows(whole.select(*keys, start, fold(F.col("__chunks"), zero).alias("__fold")))

    block_keys = [*keys, _BLOCK]
    # An explicit number of tasks: folding is heavy for its bytes, and partitions merged
    # by size would leave most cores idle.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialize(
        df.withColumn(_BLOCK, order.ranges(order.fold_rows))
        .repartition(tasks, *block_keys)
        .groupBy(*block_keys)
        .agg(F.array_sort(F.collect_list(item)).alias("__chunks"))
    )
    final = fold(F.col("__chunks"), F.col("__in"))

    def ends(from_state: DataFrame) -> DataFrame:
        """The state each block ends in and how many rows it emits, from ``__in``."""
        tried = probe(F.col("__chunks"), F.col("__in")) if probe else final
        done = from_state.select(*block_keys, "__in", tried.alias("__fold"))
        return done.select(
            *block_keys, "__in", F.col("__fold.state").alias("__out"), F.size("__fold.out").cast("bigint").alias("__n")
        )

    begin = guess(F.get("__chunks", F.lit(0))) if guess else zero

    links = previous_row(
        blocks.select(*block_keys), order.of_blocks(_BLOCK), F.col(_BLOCK), "__previous", levels=1
    )
    if links.filter(F.col("__previous").isNotNull()).isEmpty():
        return rows(blocks.withColumn("__in", zero).select(*keys, start, final.alias("__fold")))
    seen = materialize(ends(blocks.withColumn("__in", begin)))
    while True:
        wanted = _next_states(links, seen, block_keys, zero)
        new = wanted.join(seen.select(*block_keys, "__in"), [*block_keys, "__in"], "left_anti")
        if new.isEmpty():
            break
        seen = materialize(seen.unionByName(ends(blocks.join(new, block_keys))))
    states = _true_states(links, seen, wanted, block_keys).join(seen, [*block_keys, "__in"])
    # Positions go on where the block before ends, so they are dense whatever the blocks emit.
    placed = running_sum(states, order.of_blocks(_BLOCK), F.col("__n"), "__base", levels=1)
    folded = blocks.join(placed, block_keys).select(*keys, F.col("__base").cast("bigint").alias("__base"), final.alias("__fold"))
    return rows(folded)


def _next_states(links: DataFrame, seen: DataFrame, block_keys: list[str], zero: Column) -> DataFrame:
    """The states every block may start from: those its predecessor was seen to end in."""
    *keys, block = block_keys
    ended = seen.select(*keys, F.col(block).alias("__previous"), F.col("__out").alias("__in"))
    first = links.filter(F.col("__previous").isNull()).select(*block_keys, zero.alias("__in"))
    rest = links.join(ended, [*keys, "__previous"]).select(*block_keys, "__in")
    return first.unionByName(rest).distinct()


def _true_states(links: DataFrame, seen: DataFrame, wanted: DataFrame, block_keys: list[str]) -> DataFrame:
    """The one state each block starts from, by pointer doubling from the first blocks."""
    if wanted.groupBy(*block_keys).count().filter("count > 1").isEmpty():
        return wanted
    *keys, block = block_keys
    node = [*block_keys, "__in"]
    following = links.select(*keys, F.col("__previous").alias(block), F.col(block).alias("__to"))
    leap = seen.join(following, block_keys).select(*node, "__to", F.col("__out").alias("__to_in"))
    first = links.filter(F.col("__previous").isNull()).select(*block_keys)
    reached = wanted.join(first, block_keys, "left_semi")
    size = 0
    leap, reached = materialize(leap), materialize(reached)
    while (grown := reached.count()) > size:
        size = grown
        beyond = reached.join(leap, node).select(
            *keys, F.col("__to").alias(block), F.col("__to_in").alias("__in")
        )
        reached = materialize(reached.unionByName(beyond).distinct())
        second = leap.select(
            *keys,
            F.col(block).alias("__to"),
            F.col("__in").alias("__to_in"),
            F.col("__to").alias("__end"),
            F.col("__to_in").alias("__end_in"),
        )
        leap = materialize(
            leap.join(second, [*keys, "__to", "__to_in"]).select(
                *node, F.col("__end").alias("__to"), F.col("__end_in").alias("__to_in")
            )
        )
    return reached


def in_order(order: StreamOrder, *streams: DataFrame) -> DataFrame:
    """Concatenate streams: all rows of the first, then all rows of the next.

    The rows of a source stand behind the highest position of the sources before, so positions
    stay in proportion to the rows, and nothing is shuffled but one number per source.
    """
    position = F.col(order.seq).cast("bigint")
    seq = F.when((position >= 0) & (position < _LAST), position).otherwise(
        F.raise_error(F.lit(f"{order.seq} must lie in [0, 2^62)")).cast("bigint")
    )
    rooms = [df.agg(F.coalesce(F.max(position) + 1, F.lit(0))).scalar() for df in streams[:-1]]
    numbered = [df.withColumn(order.seq, reduce(Column.__add__, rooms[:i], seq)) for i, df in enumerate(streams)]
    return reduce(DataFrame.unionByName, numbered)
