"""Exact top-k by inner product over a bit-sliced index.

Rows are cut into blocks.  A block keeps, for each attribute and each binary digit of its
quantised values, one bitmap over the rows.  A query's scores over a whole block are a sum of
shifted bitmaps: attribute slices are added with carry bitmaps, 64 rows to a machine word, once
for each set digit of the query's value.  The sum is itself a bit-sliced number per row, and the
top rows are read off it from the most significant slice downward: rows with the digit set come
before those without, until the next step would exceed k.  Rows that are still alike after the
last slice have equal scores and are resolved by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows of a block of the index and queries that visit it together.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 256


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``id, dims, q``: components as ``floor(scale * x)``; unusable vectors are left out.

    Unusable are null vectors and those holding null or non-finite components; rows without an id
    are left out too.  A component whose quantised value does not fit into 63 bits fails the job.
    """
    v = F.transform(vector_col, lambda x: x.cast("double"))
    fine = lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))  # noqa: E731  false for NaN and infinity
    wide = F.raise_error(F.lit("a component is too large for scores of 64 bits")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < 2.0**62, F.floor(x * scale).cast("long")).otherwise(wide)
    return (
        vectors.select(F.col(id_col).alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine))
        .select("id", F.size("v").alias("dims"), F.transform("v", whole).alias("q"))
    )


def _bitmap(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(bits) // 64) * 64, np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), dims)


def _cell(batch: pa.RecordBatch, name: str, row: int):
    return batch.column(batch.schema.get_field_index(name))[row]


def _slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids and values to blocks of bitmaps, attribute by attribute, lowest digit first."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = _cell(batch, "ids", row).values.to_numpy(zero_copy_only=False)
            dims = _cell(batch, "dims", row).as_py()
            values = _matrix(_cell(batch, "q", row).values, dims)
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            low = values.min(axis=0)
            widths = [int(x).bit_length() for x in values.max(axis=0) - low]
            lifted = values - low
            maps = [_bitmap((lifted[:, d] >> b) & 1) for d, w in enumerate(widths) for b in range(w)]
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array([dims], pa.int32()),
                    "block": pa.array([_cell(batch, "block", row).as_py()], pa.int64()),
                    "ids": pa.array([ids], pa.list_(pa.int64())),
                    "low": pa.array([low], pa.list_(pa.int64())),
                    "widths": pa.array([widths], pa.list_(pa.int32())),
                    "slices": pa.array([b"".join(m.tobytes() for m in maps)], pa.binary()),
                }
            )


class SlicedBlock:
    """One row of the index: ``slices[d][b]`` has the rows whose value of ``d`` has digit ``b``."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, widths: list[int], slices: bytes):
        self.ids, self.low = ids, low
        self.words = -(-len(ids) // 64)
        self.high = low + np.array([(1 << w) - 1 for w in widths], np.int64)
        maps = np.frombuffer(slices, np.uint64).reshape(-1, self.words)
        # Negative weights add complements: w * x = |w| * (high - x) + w * high.
        self.maps = np.concatenate([maps, ~maps])
        self.first = np.cumsum([0, *widths])
        self.turned = len(maps)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the scores, least significant first, and what to add to each score."""
        plus = int(np.where(query > 0, query * self.low, query * self.high).sum())
        chosen: dict[int, list[int]] = {}  # by digit of the score, the bitmaps to add
        for d, w in enumerate(query.tolist()):
            start, end = int(self.first[d]), int(self.first[d + 1])
            turn = self.turned if w < 0 else 0
            for digit in range(abs(w).bit_length()):
                if abs(w) >> digit & 1:
                    for b in range(end - start):
                        chosen.setdefault(digit + b, []).append(turn + start + b)
        total: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        while chosen or carried:
            waiting = np.concatenate([self.maps[chosen.pop(len(total), [])], *carried])
            carried = []
            while len(waiting) >= 3:  # three bitmaps of one digit make a sum and a carry
                n = len(waiting) // 3
                a, b, c = waiting[:n], waiting[n : 2 * n], waiting[2 * n : 3 * n]
                odd = a ^ b
                carried.append((a & b) | (odd & c))
                waiting = np.concatenate([odd ^ c, waiting[3 * n :]])
            if len(waiting) == 2:
                carried.append((waiting[0] & waiting[1])[None])
                waiting = (waiting[0] ^ waiting[1])[None]
            total.append(waiting[0] if len(waiting) else np.zeros(self.words, np.uint64))
        return total, plus

    def values(self) -> np.ndarray:
        """The values that the slices were made of, as Python integers."""
        bits = np.unpackbits(self.maps[: self.turned].view(np.uint8), axis=1, bitorder="little")[:, : len(self.ids)]
        columns = []
        for d, low in enumerate(self.low.tolist()):
            own = bits[self.first[d] : self.first[d + 1]]
            columns.append([low + sum(int(x) << b for b, x in enumerate(row)) for row in own.T.tolist()])
        return np.array(columns, object).reshape(len(self.low), len(self.ids)).T

    def fits(self, query: np.ndarray) -> bool:
        """Whether all sums on the way to a score stay within 62 bits."""
        most = np.maximum(np.abs(self.low.astype(object)), np.abs(self.high.astype(object)))
        return int((np.abs(query.astype(object)) * (most + np.abs(self.low.astype(object)))).sum()) < 2**62

    def top_of_wide(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``top`` for values whose sums may leave 64 bits; a score that does is an error."""
        scores = (self.values() * query.astype(object)).sum(axis=1) if len(query) else np.zeros(len(self.ids), object)
        order = sorted((-int(s), i) for s, i in zip(scores, self.ids.tolist(), strict=True) if i != own)[:k]
        return np.array([i for _, i in order], np.int64), np.array([-s for s, _ in order], np.int64)

    def _places(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows but ``own``; ties go to smaller ids."""
        total, plus = self.scores(query)
        open_rows = _bitmap(self.ids != own)
        sure = np.zeros(self.words, np.uint64)
        missing = k
        for bitmap in reversed(total):
            ones = open_rows & bitmap
            n = int(np.bitwise_count(ones).sum())
            if n > missing:
                open_rows = ones
            else:
                sure |= ones
                open_rows = open_rows & ~bitmap
                missing -= n
        # Rows left open have one score; the block is in order of id.
        places = np.concatenate([self._places(sure), self._places(open_rows)[:missing]])
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        value = np.full(len(places), plus, np.int64)
        for b, bitmap in enumerate(total):
            value += ((bitmap[word] >> bit) & np.uint64(1)).astype(np.int64) << b
        return self.ids[places], value


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = SlicedBlock(
                    _cell(batch, "ids", row).values.to_numpy(zero_copy_only=False),
                    _cell(batch, "low", row).values.to_numpy(zero_copy_only=False),
                    _cell(batch, "widths", row).as_py(),
                    _cell(batch, "slices", row).as_py(),
                )
                asked = _cell(batch, "asked", row).values.to_numpy(zero_copy_only=False)
                queries = _matrix(_cell(batch, "asked_q", row).values, _cell(batch, "dims", row).as_py())
                found = [
                    (block.top if block.fits(q) else block.top_of_wide)(q, own, k)
                    for own, q in zip(asked.tolist(), queries, strict=True)
                ]
                sizes = [len(i) for i, _ in found]
                asked_rows = _cell(batch, "asked_rows", row).values.to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(asked, sizes), pa.int64()),
                        pa.array(np.repeat(asked_rows, sizes), pa.int64()),
                        pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                        pa.array(np.concatenate([s for _, s in found]), pa.int64()),
                    ],
                    names=["query_id", "query_row", "vec_id", "score"],
                )

    return run


def _blocks(df: DataFrame, size: int, block: str, ids: str, q: str) -> DataFrame:
    """Rows dealt by hash into blocks of about ``size`` vectors of one length."""
    df = df.withColumn("row", F.monotonically_increasing_id())
    counts = df.groupBy("dims").agg((F.floor(F.count("*") / size) + 1).alias("of"))
    return (
        df.join(counts, "dims")
        .withColumn(block, F.pmod(F.xxhash64("id"), F.col("of")).cast("long"))
        .groupBy("dims", block)
        .agg(F.collect_list(F.struct("id", "q", "row")).alias("r"))
        .select("dims", block, F.col("r.id").alias(ids), F.col("r.q").alias(q), F.col("r.row").alias(f"{ids}_rows"))
    )


def build_index(rows: DataFrame) -> DataFrame:
    """The bit-sliced index of ``quantised`` rows, a row per block of up to about 16,384."""
    return _blocks(rows, BLOCK_ROWS, "block", "ids", "q").mapInArrow(
        _slice, "dims int, block long, ids array<long>, low array<long>, widths array<int>, slices binary"
    )


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of each query, all if fewer.

    Both tables come from ``quantised``.  A query never finds rows with its own id, and compares
    with vectors of its own length only.  Ties go to the smaller id.  Rows with equal ids are rows
    each: a repeated query has its list once per row, a repeated row is found once per row.  Queries visit the index in blocks: every block of rows with every block of queries, so
    a task holds one block of each, whatever the sizes of the tables.  Empty tables give an
    empty result; a vector without components scores 0.
    """
    index = staged(build_index(rows), "slices")
    asking = _blocks(queries, BLOCK_QUERIES, "group", "asked", "asked_q")
    visits = index.select("dims", "block").join(asking, "dims")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # Dealt behind the join, which may gather all visits of a block in one task.
    met = visits.join(index, ["dims", "block"]).repartition(4 * cores, "dims", "block", "group")
    local = met.select("dims", "ids", "low", "widths", "slices", "asked", "asked_q", "asked_rows").mapInArrow(
        _search(k), "query_id long, query_row long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
