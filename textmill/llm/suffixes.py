"""Repeated byte strings from suffix arrays built bucket by bucket with a difference cover.

A suffix matters if the 200 bytes at its start occur again.  Those suffixes are dealt into
buckets: the key of a 200-byte string is the least hash of the 100-byte strings in it, so equal
strings meet in one bucket, and strings whose key occurs in one stretch of all documents are not
dealt at all, unless that stretch repeats a string within itself.  A bucket gets the stretches of text its suffixes lie in and sorts them in its own memory:
first by 31 bytes, then, for longer ties, by ranks of a sample of positions that were computed
before.  The sample is a difference cover: for any two positions there is a distance below 31 at
which both lie in the sample, so two suffixes that agree in 31 bytes are told apart by comparing
two numbers.  Neighbours in the sorted bucket that share 200 bytes are the repeated ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, Rolling, block_table, least, numbers, part_of, repeated_keys, rows_of, with_replies
from .common import give_back, shuffle_partitions, staged

#: Bytes of a repeated string; bytes of the strings that give its key.
LENGTH, ANCHOR = 200, 100
#: A perfect difference cover of the period.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
#: Text a bucket sorts at a time.
BUCKET_BYTES = 1 << 20


def _meeting_distances() -> np.ndarray:
    """For residues ``a`` and ``b``, the least distance at which both are in the cover."""
    table = np.empty((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if {(a + d) % PERIOD, (b + d) % PERIOD} <= set(COVER.tolist()))
    return table


_DISTANCE = _meeting_distances()


def _words(text: np.ndarray, at: np.ndarray, count: int) -> list[np.ndarray]:
    """The 8-byte words behind some positions, as numbers that compare like bytes."""
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    return [np.ascontiguousarray(eight[at + 8 * w]).view(">u8").ravel().astype(np.uint64) for w in range(count)]


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by ``keys``, the first one first, and the rank of each row; equal rows share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


class CoverRanks:
    """Ranks of the sample by at least ``LENGTH`` bytes; memory of a fifth of the positions."""

    def __init__(self, text: np.ndarray):
        """``text`` ends in zeros, ``LENGTH`` and two periods of them."""
        rounds = len(text) // PERIOD
        self.place = np.full(PERIOD, -1)
        self.place[COVER] = np.arange(len(COVER))
        at = (np.arange(rounds)[:, None] * PERIOD + COVER).ravel()
        at = at[at <= len(text) - 32]
        words = _words(text, at, 4)
        words[3] &= np.uint64(0xFFFFFFFFFFFFFF00)  # 31 bytes
        _, rank = _dense(*words)
        step, depth = len(COVER), PERIOD
        while depth < LENGTH:
            behind = np.zeros(len(rank), np.int64)
            behind[: len(rank) - step] = rank[step:] + 1
            _, rank = _dense(rank, behind)
            step, depth = 2 * step, 2 * depth
        self.rank = rank

    def __call__(self, at: np.ndarray) -> np.ndarray:
        return self.rank[at // PERIOD * len(COVER) + self.place[at % PERIOD]]


def sort_suffixes(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at`` in order of their suffixes, and which ones share 31 bytes with the one before.

    ``text`` ends in zeros as for ``CoverRanks``.  Suffixes that agree in ``LENGTH`` bytes and
    more may stand in any order among themselves.
    """
    words = _words(text, at, 4)
    words[3] &= np.uint64(0xFFFFFFFFFFFFFF00)
    order, rank = _dense(*words)
    at, group = at[order], rank[order]
    tied = np.zeros(len(at), bool)
    tied[1:] = group[1:] == group[:-1]
    if not tied.any():
        return at, tied
    ranks = CoverRanks(text)
    # Ties are split by a pivot each, all groups at once, until a group is a pivot's equals.
    open_places = np.flatnonzero(tied | np.append(tied[1:], False))
    groups = group[open_places]
    while len(open_places):
        first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
        sizes = np.diff(np.append(first, len(groups)))
        pivot = np.repeat(at[open_places[first + sizes // 2]], sizes)
        own = at[open_places]
        apart = _DISTANCE[own % PERIOD, pivot % PERIOD]
        side = np.sign(ranks(own + apart) - ranks(pivot + apart))
        label = np.repeat(np.arange(len(first)), sizes) * 3 + side + 1
        turn = np.argsort(label, kind="stable")
        at[open_places] = own[turn]
        label = label[turn]
        size_of = np.bincount(label)
        going = (label % 3 != 1) & (size_of[label] > 1)
        open_places, groups = open_places[going], label[going]
    return at, tied


def repeated_positions(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the positions ``at`` whose next ``LENGTH`` bytes stand at another one of them."""
    at, tied = sort_suffixes(text, at)
    pairs = np.flatnonzero(tied)
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    for w in range(LENGTH // 8):
        same = (eight[at[pairs] + 8 * w] == eight[at[pairs - 1] + 8 * w]).all(1)
        pairs = pairs[same]
    return np.unique(np.concatenate([at[pairs], at[pairs - 1]]))


class Stretches:
    """Runs of neighbouring 200-byte strings of one key in one document."""

    def __init__(self, block: Block):
        self.rolling = Rolling.of_bytes(block.text)
        anchors = self.rolling.every(ANCHOR)
        keys = least(anchors, LENGTH - ANCHOR + 1)
        # Where the least anchor comes first and again before the window ends: periodic text.
        again = (anchors[: len(keys)] == keys) & (least(anchors, LENGTH - ANCHOR)[1 : len(keys) + 1] == keys)
        inside = np.zeros(len(keys) + 1, np.int64)
        long = block.ends - block.starts >= LENGTH
        np.add.at(inside, block.starts[long], 1)
        np.add.at(inside, block.ends[long] - LENGTH + 1, -1)
        at = np.flatnonzero(np.cumsum(inside)[:-1])
        keys = keys[at]
        breaks = np.ones(len(at), bool)
        # A document's last 199 positions start no string, so runs never cross into the next one.
        breaks[1:] = (keys[1:] != keys[:-1]) | (np.diff(at) != 1)
        first = np.flatnonzero(breaks)
        self.starts = at[first]
        self.counts = np.diff(np.append(first, len(at)))
        self.keys = keys[first]
        self.periodic = np.add.reduceat(again[at], first, dtype=np.int64) > 0 if len(first) else np.zeros(0, bool)

    def _ruled(self) -> np.ndarray:
        """Stretches that hold a 200-byte string twice.

        Equal strings of a stretch of up to 101 are at most 100 apart, so the text from the first
        to the second has that period and so have its anchors: the least one comes again.
        """
        found = self.counts > LENGTH - ANCHOR + 1  # may rule more than needed
        some = np.flatnonzero(self.periodic & ~found)
        counts = self.counts[some]
        label = np.repeat(some, counts)
        at = np.arange(len(label)) + np.repeat(self.starts[some] - (np.cumsum(counts) - counts), counts)
        strings = self.rolling.stretches(at, at + LENGTH)
        order = np.lexsort((strings, label))
        same = (label[order][1:] == label[order][:-1]) & (strings[order][1:] == strings[order][:-1])
        found[label[order][1:][same]] = True
        return found

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = np.unique(self.keys, return_counts=True)
        known = n > 1
        # A stretch can also repeat strings within itself.
        known[np.searchsorted(keys, self.keys[self._ruled()])] = True
        return keys, known


def _stretch_keys(block: Block) -> tuple[np.ndarray, np.ndarray]:
    return Stretches(block).distinct_keys()


_DEALT = "part long, key long, block long, starts array<int>, text binary"


def _deal_stretches(parts: int):
    """Stretches whose key is shared, equal ones of a block once, with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row in rows_of(batches):
            shared = numbers(batch, "keys", row)
            if not len(shared):
                continue
            block = Block(batch, row)
            runs = Stretches(block)
            used = np.isin(runs.keys, shared)
            starts, keys = runs.starts[used], runs.keys[used]
            ends = starts + runs.counts[used] + LENGTH - 1
            same = runs.rolling.stretches(starts, ends)
            order = np.lexsort((same, keys))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(keys[order]) != 0) | (np.diff(same[order]) != 0)
            first = np.flatnonzero(new)
            raw = memoryview(block.raw)
            places = np.split(starts[order].astype(np.int32), first[1:])
            own = order[first]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(part_of(keys[own], parts)),
                    "key": pa.array(keys[own].view(np.int64)),
                    "block": pa.array(np.full(len(first), block.number)),
                    "starts": pa.array(places, pa.list_(pa.int32())),
                    "text": pa.array([bytes(raw[a:b]) for a, b in zip(starts[own], ends[own], strict=True)], pa.binary()),
                }
            )

    return run


def _resolve(table: pa.Table) -> pa.Table:
    """Repeated strings of one part: ``block, starts, found``, a bit per string of a stretch."""
    texts = table.column("text").combine_chunks().dictionary_encode()
    copies = texts.indices.to_numpy(zero_copy_only=False)
    distinct = texts.dictionary
    of_places = table.column("starts").combine_chunks()
    places = np.asarray(of_places.value_lengths())
    # A stretch that stands twice is repeated as a whole.
    times = np.bincount(copies, places, len(distinct))
    offsets = np.frombuffer(distinct.buffers()[1], np.int32)[distinct.offset : distinct.offset + len(distinct) + 1]
    sizes = np.diff(offsets)
    # A bucket is a set of keys, so the part is sorted key by key in pieces of bounded size.
    key = np.zeros(len(distinct), np.int64)
    key[copies] = table.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    piece = np.cumsum(sizes[order]) // BUCKET_BYTES
    new_key = np.append(True, key[order][1:] != key[order][:-1])
    piece = np.maximum.accumulate(np.where(new_key, piece, 0))  # a key stays in the piece it begins in
    flags: list[bytes] = [b""] * len(distinct)
    raw = np.frombuffer(distinct.buffers()[2], np.uint8)
    for bounds in np.split(np.arange(len(order)), np.flatnonzero(np.diff(piece)) + 1):
        chosen = order[bounds]
        lengths = sizes[chosen]
        begins = np.cumsum(lengths) - lengths
        source = np.repeat(offsets[chosen] - begins, lengths) + np.arange(int(lengths.sum()))
        text = np.concatenate([raw[source], np.zeros(LENGTH + 2 * PERIOD, np.uint8)])
        counts = lengths - LENGTH + 1
        at = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        hit = np.zeros(len(text), bool)
        hit[repeated_positions(text, at)] = True
        for d, begin, count in zip(chosen.tolist(), begins.tolist(), counts.tolist(), strict=True):
            flags[d] = np.packbits(hit[begin : begin + count]).tobytes()
    whole = np.flatnonzero(times > 1)
    for d in whole.tolist():
        flags[d] = np.packbits(np.ones(int(sizes[d]) - LENGTH + 1, bool)).tobytes()
    give_back()
    useful = np.array([any(f) for f in flags], bool)[copies]
    counts = (sizes - LENGTH + 1)[copies[useful]]
    return pa.table(
        {
            "block": table.column("block").filter(pa.array(useful)),
            "starts": of_places.filter(pa.array(useful)),
            "count": pa.array(counts, pa.int32()),
            "found": pa.array([flags[d] for d in copies[useful].tolist()], pa.binary()),
        }
    )


def _remove(with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row in rows_of(batches):
            block = Block(batch, row)
            change = np.zeros(len(block.text) + 1, np.int32)
            for reply in batch.column(batch.schema.get_field_index("replies"))[row].as_py() or []:
                hits = np.flatnonzero(np.unpackbits(np.frombuffer(reply["found"], np.uint8), count=reply["count"]))
                at = (np.array(reply["starts"], np.int64)[:, None] + hits).ravel()
                np.add.at(change, at, 1)
                np.add.at(change, at + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            raw = memoryview(block.raw)
            out: dict[str, list] = {"n": [], "removed": [], "spans": [], "sha": [], "where": []}
            for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
                edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                digest, at = hashlib.sha256(), a
                for start, end in (edges + a).tolist():
                    digest.update(raw[at:start])
                    at = end
                digest.update(raw[at:b])
                out["n"].append(b - a)
                out["removed"].append(int((edges[:, 1] - edges[:, 0]).sum()))
                out["spans"].append(len(edges))
                out["sha"].append(digest.hexdigest())
                out["where"].append([{"start": s, "end": e} for s, e in edges.tolist()] if with_spans else None)
            columns = {
                "doc_id": block.ids.values,
                "n_bytes": pa.array(out["n"], pa.int64()),
                "n_removed": pa.array(out["removed"], pa.int64()),
                "n_spans": pa.array(out["spans"], pa.int64()),
                "kept_sha256": pa.array(out["sha"], pa.string()),
            }
            if with_spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns["spans"] = pa.array(out["where"], kind)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def remove_repeated_bytes(docs: DataFrame, with_spans: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: texts without repeated 200-byte strings.

    A byte goes if a 200-byte string that covers it also starts anywhere else, in another
    document or the same; overlapping occurrences count, and all of them go, also the first.
    Strings lie within one document.  Null texts are empty; texts below 200 bytes lose nothing.
    Repeated rows, also with equal ids, repeat each other.  Other columns are ignored.
    ``with_spans`` adds ``spans (start, end)`` in bytes.
    """
    blocks = block_table(docs, "bytes")
    parts = 2 * shuffle_partitions(docs.sparkSession)
    shared = staged(repeated_keys(blocks, _stretch_keys), "keys")
    dealt = with_replies(blocks, shared).mapInArrow(_deal_stretches(parts), _DEALT)
    found = dealt.groupBy("part").applyInArrow(_resolve, "block long, starts array<int>, count int, found binary")
    replies = found.groupBy("block").agg(F.collect_list(F.struct("starts", "count", "found")).alias("replies"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_spans:
        schema += ", spans array<struct<start:long,end:long>>"
    return with_replies(blocks, replies).mapInArrow(_remove(with_spans), schema)
