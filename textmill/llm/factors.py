"""Repeated passages by relative Lempel-Ziv parsing against everything that came before.

The reference of a document is all documents with a smaller id.  It is indexed block by block:
every run of 13 words leads to the smallest id it occurs in.  A document is read from the front.
Where its next 13 words are in the index, the factor starts there and grows word by word as long
as the same earlier document goes on; where not, the word is a literal.  Factors of 13 words and
more are copies.  Where a factor ends, the 12 runs that cross its end may be in other earlier
documents; each of them is looked up as well, so no copied run is missed between two factors.

Looking up every run of every document would move more than the texts.  So a run is looked up
only if the rarest-looking five words in it (the least of nine hashes) occur in another document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Block, block_table, joined, least, numbers, part_of, repeated_keys, rows_of, with_replies, word_hashes
from .common import SPACES, shuffle_partitions, staged

#: Words of a run; words of an anchor within it.
RUN, ANCHOR = 13, 5
_IS_SPACE = np.isin(np.arange(256), list(SPACES))


class Words:
    """Words of a block: hashes, the document of each, and runs of 13 by their first word."""

    def __init__(self, block: Block):
        blank = np.ones(len(block.text) + 2, bool)
        blank[1:-1] = _IS_SPACE[block.text]
        begins = blank[:-1] & ~blank[1:]
        begins[block.starts[block.starts < block.ends]] |= ~blank[1:][block.starts[block.starts < block.ends]]
        starts = np.flatnonzero(begins)
        stops = ~blank[:-1] & blank[1:]
        # A word also ends where its document does.
        cut = block.ends[block.ends > block.starts]
        stops[cut] |= ~blank[:-1][cut]
        ends = np.flatnonzero(stops)
        self.doc = np.searchsorted(block.ends, starts, side="right")
        self.first = np.searchsorted(starts, block.starts)
        self.count = np.append(self.first[1:], len(starts)) - self.first
        self.hashes = word_hashes(block.text, starts, ends)
        self.runs = joined(self.hashes, RUN)
        whole = self.doc[: len(self.runs)] == self.doc[RUN - 1 :] if len(self.runs) else np.zeros(0, bool)
        self.at = np.flatnonzero(whole)
        self.runs = self.runs[self.at]
        self.anchors = least(joined(self.hashes, ANCHOR), RUN - ANCHOR + 1)[self.at]


def _anchor_keys(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors, and whether an anchor is in two documents of the block."""
    words = Words(block)
    ids = block.order()[words.doc[words.at]]
    order = np.lexsort((ids, words.anchors))
    keys, ids = words.anchors[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], ids[first] != ids[last]


def _least_id(runs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, runs))
    runs, ids = runs[order], ids[order]
    new = np.ones(len(runs), bool)
    new[1:] = runs[1:] != runs[:-1]
    return runs[new], ids[new]


def _index_entries(parts: int):
    """Entries of the index: runs with a shared anchor, and the smallest id of the block's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row in rows_of(batches):
            shared = numbers(batch, "keys", row)
            if not len(shared):
                continue
            block = Block(batch, row)
            words = Words(block)
            used = np.isin(words.anchors, shared)
            runs, ids = _least_id(words.runs[used], block.order()[words.doc[words.at[used]]])
            part = part_of(runs, parts)
            order = np.lexsort((runs, part))
            runs, ids, part = runs[order], ids[order], part[order]
            there, first = np.unique(part, return_index=True)
            cells = list(zip(first, np.append(first[1:], len(part)), strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(there),
                    "block": pa.array(np.full(len(there), block.number)),
                    "runs": pa.array([runs[a:b].tobytes() for a, b in cells], pa.binary()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in cells], pa.binary()),
                }
            )

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """For each block, the runs that some other block has in a smaller id, and that id."""
    table = table.combine_chunks()
    runs = [np.frombuffer(c.as_buffer(), np.uint64) for c in table.column("runs")]
    ids = [np.frombuffer(c.as_buffer(), np.int64) for c in table.column("ids")]
    every, smallest = _least_id(np.concatenate(runs), np.concatenate(ids))
    out: dict[str, list] = {"block": [], "runs": [], "ids": []}
    for block, own, least_own in zip(table.column("block").to_pylist(), runs, ids, strict=True):
        best = smallest[np.searchsorted(every, own)]
        smaller = best < least_own
        if smaller.any():
            out["block"].append(block)
            out["runs"].append(own[smaller].tobytes())
            out["ids"].append(best[smaller].tobytes())
    return pa.table(
        {
            "block": pa.array(out["block"], pa.int64()),
            "runs": pa.array(out["runs"], pa.binary()),
            "ids": pa.array(out["ids"], pa.binary()),
        }
    )


def parse(sources: np.ndarray) -> list[tuple[int, int, int]]:
    """Factors ``first word, words, source`` of one document.

    ``sources`` has, for the run at each word, the earlier document it is in, or -1.
    """
    factors = []
    found = np.flatnonzero(sources >= 0)
    if not len(found):
        return factors
    # A factor goes on while the next run is in the same document; a run in another one, also
    # one that crosses the end of the factor, starts the next.
    breaks = np.flatnonzero((np.diff(found) != 1) | (np.diff(sources[found]) != 0)) + 1
    for part in np.split(found, breaks):
        factors.append((int(part[0]), len(part) + RUN - 1, int(sources[part[0]])))
    return factors


def _factor(with_factors: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row in rows_of(batches):
            block = Block(batch, row)
            words = Words(block)
            order = block.order()
            runs, ids = numbers(batch, "runs", row), numbers(batch, "earliest", row, np.int64)
            shared = np.isin(words.anchors, numbers(batch, "keys", row))
            own_runs, own_ids = _least_id(words.runs[shared], order[words.doc[words.at[shared]]])
            every, smallest = _least_id(np.concatenate([own_runs, runs]), np.concatenate([own_ids, ids]))
            source = np.full(len(words.hashes), -1, np.int64)
            at = words.at[shared]
            best = smallest[np.searchsorted(every, words.runs[shared])]
            earlier = best < order[words.doc[at]]
            # -1 stands for no source, so ids are told apart by their rank.
            ranks = np.unique(best[earlier])
            source[at[earlier]] = np.searchsorted(ranks, best[earlier])
            raw = memoryview(block.raw)
            out: dict[str, list] = {"n_words": [], "n_removed": [], "sha": [], "kept": [], "factors": []}
            for doc, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist(), strict=True)):
                first, n = int(words.first[doc]), int(words.count[doc])
                factors = parse(source[first : first + n])
                text = bytes(raw[a:b]).split()  # at the six white space characters
                assert len(text) == n
                if factors:
                    copied = np.zeros(n, bool)
                    for start, length, _ in factors:
                        copied[start : start + length] = True
                    text = [text[i] for i in np.flatnonzero(~copied)]
                kept = b" ".join(text)
                out["n_words"].append(n)
                out["n_removed"].append(n - len(text))
                out["sha"].append(hashlib.sha256(kept).hexdigest())
                if with_factors:
                    out["kept"].append(kept.decode() if factors else bytes(raw[a:b]).decode())
                    out["factors"].append(
                        [{"first": s, "words": m, "source": int(ranks[k])} for s, m, k in
                         ((s, m, source[first + s]) for s, m, _ in factors)]
                    )
            columns = {
                "doc_id": block.ids.values,
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "kept_sha256": pa.array(out["sha"], pa.string()),
            }
            if with_factors:
                kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("source", pa.int64())]))
                cell = batch.column(batch.schema.get_field_index("carried"))[row]
                columns |= {"carried": cell.values, "kept": pa.array(out["kept"], pa.string()), "factors": pa.array(out["factors"], kind)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _found(docs: DataFrame, carry: Column | None) -> DataFrame:
    """Blocks with their shared anchors and with the runs that start in earlier documents."""
    blocks = block_table(docs, "words", carry)
    parts = shuffle_partitions(docs.sparkSession)
    shared = staged(repeated_keys(blocks, _anchor_keys), "anchors")
    marked = with_replies(blocks, shared)
    entries = marked.mapInArrow(_index_entries(parts), "part long, block long, runs binary, ids binary")
    found = entries.groupBy("part").applyInArrow(_earlier, "block long, runs binary, ids binary")
    replies = found.groupBy("block").agg(F.collect_list("runs").alias("runs"), F.collect_list("ids").alias("earliest"))
    return with_replies(marked, replies)


_COUNTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_copied_words(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``: documents without runs copied from earlier ones.

    Words are runs of anything but the six ASCII white space characters.  A word goes if it is
    in a run of 13 words that also starts in a document with a smaller id; what is removed
    elsewhere makes no difference.  Null texts and texts of fewer than 13 words lose nothing.
    Rows with equal ids do not copy from each other; null ids count as larger than all others.
    Other columns are ignored.

    Runs are compared by 64-bit hashes.
    """
    return _found(docs, None).mapInArrow(_factor(False), _COUNTS)


def factored(docs: DataFrame, carry: Column) -> DataFrame:
    """The same with ``carried``, ``kept`` and ``factors (first, words, source)``.

    ``carried`` is the value of ``carry`` for the row.  ``kept`` is the text as it is if nothing
    goes, otherwise the words left joined by spaces.  ``factors`` are the copied stretches of
    words and the documents they start in.
    """
    found = _found(docs, carry)
    kind = found.schema["carried"].dataType.elementType.simpleString()
    more = f"carried {kind}, kept string, factors array<struct<first:long,words:long,source:long>>"
    return found.mapInArrow(_factor(True), f"{_COUNTS}, {more}")
