"""Documents in blocks of a few megabytes, and which keys of a block occur elsewhere too.

A block is a row: its number, the ids of its documents, where they end, and their bytes.  Blocks
are written once, bucketed by number, so that later passes join what was found out about a block
to its text without moving the text.  Between blocks only keys travel: each block sends every
key once, packed by the part of the key space it belongs to, and gets back those that are not
its own alone.  A key that a third of all documents hold costs a row per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import shared_folder

from .common import give_back, shuffle_partitions

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


class Block:
    """One row of blocks, as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int = 0):
        cell = lambda name: batch.column(batch.schema.get_field_index(name))[row]
        self.number: int = cell("block").as_py()
        self.ids = cell("ids")
        self.ends = cell("ends").values.to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.raw = cell("text").as_buffer()
        self.text = np.frombuffer(self.raw, np.uint8)

    def order(self) -> np.ndarray:
        """Ids to compare by; null ids stand behind all others."""
        return np.array([2**63 - 1 if i is None else i for i in self.ids.as_py()], np.int64)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch, row
        give_back()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids, texts, carried, size = [], [], [], 0
    kind = None

    def row() -> pa.RecordBatch:
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([number], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "ends": pa.array([ends], pa.list_(pa.int64())),
                "text": pa.array([b"".join(texts)], pa.binary()),
                "carried": pa.array([carried], pa.list_(kind)),
            }
        )

    for batch in batches:
        kind = batch.schema.field(2).type
        columns = (batch.column(i).to_pylist() for i in range(3))
        for doc_id, text, more in zip(*columns, strict=True):
            if texts and size + len(text or b"") > BLOCK_BYTES:
                yield row()
                ids, texts, carried, size, number = [], [], [], 0, number + 1
            ids.append(doc_id)
            texts.append(text or b"")
            carried.append(more)
            size += len(texts[-1])
    if texts:
        yield row()


def block_table(docs: DataFrame, name: str, carry: Column | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of all rows in blocks, null text as empty, bucketed by ``block``.

    ``carry`` is a value of each row that stays beside it.
    """
    spark = docs.sparkSession
    table = f"textmill_{name}_{uuid.uuid4().hex}"
    plain = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string").cast("binary").alias("text"),
        (F.lit(None).cast("int") if carry is None else carry).alias("carried"),
    )
    kind = plain.schema["carried"].dataType.simpleString()
    (
        plain.mapInArrow(_pack, f"block long, ids array<long>, ends array<long>, text binary, carried array<{kind}>")
        .write.bucketBy(shuffle_partitions(spark), "block")
        .option("path", f"{shared_folder(spark).rstrip('/')}/{table}")
        .saveAsTable(table)
    )
    return spark.table(table)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


_byte_values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = np.ones((2, 1), np.uint64)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if _powers.shape[1] < n:
        steps = np.empty((2, n), np.uint64)
        steps[:, 0] = 1
        steps[0, 1:], steps[1, 1:] = _BASE, pow(_BASE, -1, 2**64)
        _powers = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers[0, :n], _powers[1, :n]


class Rolling:
    """Hashes of any stretch of a sequence, from sums of values times powers."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers_to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    @classmethod
    def of_bytes(cls, text: np.ndarray) -> Rolling:
        return cls(_byte_values[text])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all stretches of ``length``, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def joined(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` values, by start.

    Runs are put together from shorter ones, doubling, and mixed at every step, so that no
    pattern of repetitions cancels out as it may in a sum of powers.
    """
    put = lambda a, b: mixed(a * np.uint64(0xC2B2AE3D27D4EB4F) + b)
    level, span, done, reach = values, 1, None, 0
    while True:
        if length & span:
            rest = level[reach:]
            done = rest if done is None else put(done[: len(rest)], rest)
            reach += span
        if span * 2 > length:
            return done[: max(0, len(values) - length + 1)]
        level = put(level[:-span], level[span:]) if len(level) > span else level[:0]
        span *= 2


#: Values of bytes by place, for the first places of a word.
_PLACES = 64
_place_step = np.uint64(0x9FB21C651E98DF25)
_placed = mixed((np.arange(1, _PLACES + 1, dtype=np.uint64) * _place_step)[:, None] + _byte_values[None, :]).ravel()
#: Bytes looked at in one go.
_GO = 1 << 18


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes that do not overlap, in order: sums of a random value for each byte and place."""
    out = np.zeros(len(starts), np.uint64)
    sizes = ends - starts
    reach = np.cumsum(sizes)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(reach, (reach[low - 1] if low else 0) + _GO, side="right")))
        n = sizes[low:high]
        # One long word alone, in several goes.
        for skip in range(0, max(int(n.max()), 1), _GO) if high == low + 1 else (0,):
            part = np.minimum(n - skip, _GO)
            begins = np.cumsum(part) - part
            place = np.arange(int(part.sum())) - np.repeat(begins, part) + skip
            seen = text[place + np.repeat(starts[low:high], part)]
            if len(place) and place.max() < _PLACES:
                values = _placed[place * 256 + seen]
            else:
                values = mixed((place + 1).astype(np.uint64) * _place_step + _byte_values[seen])
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            out[low:high] += sums[begins + part] - sums[begins]
        low = high
    return mixed(out)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values, by start."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    reach, span = values, 1
    while span * 2 <= width:
        reach = np.minimum(reach[:-span], reach[span:])
        span *= 2
    return np.minimum(reach[:n], reach[width - span : width - span + n])


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part a key belongs to.  Keys are often least values, so they are mixed once more."""
    spread = mixed(keys ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)
    return (spread * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _deal(keys_of: Callable[[Block], tuple[np.ndarray, np.ndarray]], parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row in rows_of(batches):
            block = Block(batch, row)
            keys, known = keys_of(block)
            part = part_of(keys, parts)
            order = np.argsort(part, kind="stable")
            keys, known, part = keys[order], known[order], part[order]
            there, first = np.unique(part, return_index=True)
            ends = np.append(first[1:], len(part))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(there),
                    "block": pa.array(np.full(len(there), block.number)),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                    "known": pa.array([known[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                }
            )

    return run


def _meet(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    parts = [np.frombuffer(k.as_buffer(), np.uint64) for k in table.column("keys")]
    known = np.concatenate([np.frombuffer(k.as_buffer(), bool) for k in table.column("known")])
    sizes = [len(p) for p in parts]
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    known[order] |= same[1:] | same[:-1]
    out, blocks, at = [], [], 0
    for block, size in zip(table.column("block").to_pylist(), sizes, strict=True):
        found = keys[at : at + size][known[at : at + size]]
        if len(found):
            blocks.append(block)
            out.append(found.tobytes())
        at += size
    return pa.table({"block": pa.array(blocks, pa.int64()), "keys": pa.array(out, pa.binary())})


def repeated_keys(blocks: DataFrame, keys_of: Callable[[Block], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``block, keys``: of each block those keys that also occur elsewhere, packed.

    ``keys_of`` gives a block's distinct keys and whether each is already known to occur twice.
    """
    parts = shuffle_partitions(blocks.sparkSession)
    dealt = blocks.mapInArrow(_deal(keys_of, parts), "part long, block long, keys binary, known binary")
    met = dealt.groupBy("part").applyInArrow(_meet, "block long, keys binary")
    return met.groupBy("block").agg(F.collect_list("keys").alias("keys"))


def with_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Blocks beside what was found for them; the text stays where it is."""
    return blocks.join(replies.hint("shuffle_hash"), "block", "left")


def numbers(batch: pa.RecordBatch, name: str, row: int, kind=np.uint64) -> np.ndarray:
    """All numbers of a list of packed cells; none for null."""
    cells = batch.column(batch.schema.get_field_index(name))[row].as_py() or []
    return np.concatenate([np.frombuffer(c, kind) for c in cells] or [np.zeros(0, kind)])
