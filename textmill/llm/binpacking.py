"""Packing instruction examples into sequences under several limits at once.

Vector bin packing: an example weighs tokens, one segment and loss-bearing tokens, and a sequence
has a limit for each.  The sequence being filled takes the example whose weights have the largest
dot product with the room left, both as shares of the limits, so that examples heavy in what is
plentiful come first.  When none fits whole, one is cut to fill the room; what is cut off waits
for a later sequence.  A sequence that another limit closes early is cut back to a power of two,
the lengths that need no padding.

Every task packs its own documents while it reads them, some hundred waiting at a time.  Nothing
is shuffled, and what a task has left at the end of a slice of texts waits for the next slice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCache, give_back, text_slices
from .packing import _Encoder, vocabulary

#: Examples that wait to be chosen from.
WAITING = 256


class Limits(NamedTuple):
    """What a sequence may hold.  Each is 1 or more; sequences are padded to ``tokens``."""

    tokens: int = 2048
    segments: int = 32
    loss: int = 1984


class Piece(NamedTuple):
    """``length`` tokens of an example from ``start`` on, at ``offset`` of a sequence."""

    example: int
    start: int
    length: int
    sequence: int
    offset: int


class Packer:
    """Fills sequences from examples of ``size`` tokens, the first ``free`` of which bear no loss."""

    def __init__(self, limits: Limits = Limits()):
        if min(limits) < 1:
            raise ValueError(f"limits must be 1 or more: {limits}")
        self.limits = limits
        self.sequence = 0

    def run(self, size: np.ndarray, free: np.ndarray, last: bool) -> tuple[list[Piece], np.ndarray]:
        """Pieces, and how many leading tokens of each example are placed.

        Unless ``last``, packing stops when no more than a sequence might be left unfilled.
        """
        self.size, self.free = size.astype(np.int64), free.astype(np.int64)
        self.placed = np.zeros(len(size), np.int64)
        self.queue = 0
        self.example = np.full(WAITING, -1, np.int64)
        self.left, self.light = np.zeros(WAITING, np.int64), np.zeros(WAITING, np.int64)
        for slot in range(WAITING):
            self._refill(slot)
        waiting, out = int(self.size.sum()), []
        while waiting and (last or waiting >= 2 * self.limits.tokens):
            pieces = self._fill()
            waiting -= sum(p.length for p in pieces)
            out += pieces
            self.sequence += 1
        return out, self.placed

    def _refill(self, slot: int) -> None:
        self.example[slot] = -1
        self.left[slot] = self.light[slot] = 0
        if self.queue < len(self.size):
            self._show(slot, self.queue)
            self.queue += 1

    def _show(self, slot: int, example: int) -> None:
        self.example[slot] = example
        self.left[slot] = self.size[example] - self.placed[example]
        self.light[slot] = max(0, self.free[example] - self.placed[example])

    def _choose(self, tokens: int, segments: int, loss: int) -> tuple[int, int]:
        """The slot to take from and how many of its tokens; none if there is no room for any."""
        limits = self.limits
        # As many leading tokens of each as there is room for.
        part = np.minimum(np.minimum(self.left, tokens), self.light + loss)
        fits = part == self.left
        bears = part - np.minimum(part, self.light)
        # Those that no sequence could hold are cut in any case.
        whole = (fits | (self.left > limits.tokens)) & (part > 0)
        value = part * (tokens / limits.tokens**2) + bears * (loss / limits.loss**2) + segments / limits.segments**2
        slot = int(np.argmax(np.where(whole, value, 0)))
        if not whole[slot]:
            slot = int(np.argmax(part))
        return slot, int(part[slot])

    def _fill(self) -> list[Piece]:
        tokens, segments, loss = self.limits
        pieces, slots = [], []
        while tokens and segments:
            slot, n = self._choose(tokens, segments, loss)
            if not n:
                break
            example = int(self.example[slot])
            start = int(self.placed[example])
            pieces.append(Piece(example, start, n, self.sequence, self.limits.tokens - tokens))
            slots.append(slot)
            loss -= n - min(n, int(self.light[slot]))
            tokens, segments = tokens - n, segments - 1
            self.placed[example] += n
            self._show(slot, example)
        total = self.limits.tokens - tokens
        # Too short: back to a power of two, from the end.
        surplus = total - (1 << total.bit_length() - 1) if tokens else 0
        while surplus:
            piece = pieces.pop()
            off = min(surplus, piece.length)
            self.placed[piece.example] -= off
            self._show(slots[len(pieces)], piece.example)
            if off < piece.length:
                pieces.append(piece._replace(length=piece.length - off))
            surplus -= off
        for slot in set(slots):
            if not self.left[slot]:
                self._refill(slot)
        return pieces


def _pack(path: str, limits: Limits, share: tuple[int, int], with_ids: bool):
    def tokens_of(encoder: _Encoder, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of prompts and texts in a row, sizes of the examples, and ids of each that bear no loss."""
        ids, starts = encoder.ids(batch.column(batch.schema.get_field_index("text")))
        at = batch.schema.get_field_index("prompt")
        if at < 0:
            sizes = np.diff(starts)
            return ids, sizes, sizes * share[0] // share[1]
        more, firsts = encoder.ids(batch.column(at))
        # A prompt has no end id of its own.
        free, own = np.diff(firsts) - 1, np.diff(starts)
        sizes = free + own
        begins = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), ids.dtype)
        place = np.arange(len(more)) - np.repeat(firsts[:-1] - begins, free + 1)
        inside = np.ones(len(more), bool)
        inside[firsts[1:] - 1] = False
        out[place[inside]] = more[inside]
        out[np.arange(len(ids)) + np.repeat(begins + free - starts[:-1], own)] = ids
        return out, sizes, free

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _Encoder.of(path), Packer(limits)
        number = TaskContext.get().partitionId() << 32
        none = np.zeros(0, np.int64)
        # What waits: ids in a row, and of each example its id, its size, those bearing no loss, and those gone before.
        ids, doc_ids, whole, free, gone = np.zeros(0, "<u4"), pa.array([], pa.int64()), none, none, none

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal ids, doc_ids, whole, free, gone
            rest = whole - gone
            begins = np.cumsum(rest) - rest
            pieces, placed = packer.run(rest, np.maximum(free - gone, 0), last)
            example, start, length, sequence, offset = np.array(pieces, np.int64).reshape(-1, 5).T
            begin = begins[example] + start
            raw = memoryview(np.ascontiguousarray(ids)).cast("B")
            spans = list(zip(begin.tolist(), length.tolist(), strict=True))
            start = start + gone[example]
            out = {
                "doc_id": doc_ids.take(pa.array(example)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in spans], pa.int64()),
                "doc_tokens": pa.array(whole[example]),
                "sequence_id": pa.array(sequence + number),
                "offset": pa.array(offset),
                "loss_tokens": pa.array(start + length - np.maximum(start, np.minimum(free[example], start + length))),
            }
            if with_ids:
                out["ids"] = pa.array([ids[a : a + n].astype(np.int32) for a, n in spans], pa.list_(pa.int32()))
            stays = np.flatnonzero(placed < rest)
            ids = np.concatenate([ids[begins[i] + placed[i] : begins[i] + rest[i]] for i in stays] or [ids[:0]])
            gone = (gone + placed)[stays]
            whole, free, doc_ids = whole[stays], free[stays], doc_ids.take(pa.array(stays))
            return pa.RecordBatch.from_pydict(out)

        for batch in text_slices(batches, "text"):
            new, sizes, light = tokens_of(encoder, batch)
            ids = np.concatenate([ids, new.astype("<u4", copy=False)])
            doc_ids = pa.concat_arrays([doc_ids, batch.column(batch.schema.get_field_index("doc_id"))])
            whole, free = np.concatenate([whole, sizes]), np.concatenate([free, light])
            gone = np.concatenate([gone, np.zeros(len(sizes), np.int64)])
            yield packed(False)
        yield packed(True)
        # The vocabulary stays in the worker, the words of one task do not.
        encoder.cache = WordCache(encoder._encode)
        give_back()

    return run


def pack_examples(
    examples: DataFrame,
    limits: Limits = Limits(),
    prompt: Column | None = None,
    share: tuple[int, int] = (1, 8),
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens`` of each piece.

    An example is its prompt, its text and the end id 1, as ids of the vocabulary at ``path``.
    The ids of ``prompt`` bear no loss; without a prompt the leading ``share`` of an example's ids,
    rounded down, stands for its instruction.  Pieces of one example are pieces of one text cut
    where sequences were full.  No sequence exceeds a limit, and one shorter than ``limits.tokens``
    has a power of two of tokens.  ``with_ids`` adds the ids.

    Needs ``doc_id`` and ``text``; other columns are ignored.  Null texts and prompts are empty; an
    example of neither is the end id alone.  Repeated rows are packed each, null ids too.  An empty
    table gives an empty result.  The ids of one text must fit into a worker.
    """
    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    if prompt is not None:
        columns.append(F.coalesce(prompt.cast("string"), F.lit("")).alias("prompt"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
    rows = examples.select(*columns)
    return rows.mapInArrow(_pack(path or vocabulary(), limits, share, with_ids), schema + ", ids array<int>" * with_ids)
