"""Fill-in-middle: a text is cut in three at line ends and put together in another order.

Secondary-sort assembly: every document is cut into pieces of whole lines, keyed by document and by
their position in the output.  One repartition by document, sorted by that key within partitions,
then streams the pieces of each output in order, so that an output is digested, or parsed back at
its markers, piece by piece and never held as a whole.  What is parsed back is sorted once more
within the same partitions, by position in the text, which restores the text without another
shuffle.

The pieces of one document are in one partition, since a digest is a chain; a document of any
length passes through it a few kilobytes at a time, and the sort spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_slices

#: Bytes of a piece; a longer line is cut.
PIECE_BYTES = 8 << 10
#: Bytes of a batch that a stream hands on.
BATCH_BYTES = 2 << 20
#: Positions count pieces within a segment; segments are this far apart.
SEGMENT = 1 << 40

_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_PIECES = f"row long, position long, piece binary, {_FACTS}"
_RESTORING = f"{_PIECES}, output_sha256 string"
_NO_FACTS = (None,) * 5


class Middle(NamedTuple):
    """How texts are cut: the seed of the ids' hash, the share that is cut, of these the share in
    suffix-first form, both in percent, and the markers of prefix, suffix and middle."""

    seed: int = 7
    percent: int = 100
    spm_percent: int = 50
    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def marks(self) -> tuple[bytes, bytes, bytes]:
        prefix, suffix, middle = (m.encode() for m in self.markers)
        return prefix, suffix, middle

    def order(self, form: str) -> list[tuple[bytes, int]]:
        """Marker and place in the text (0 prefix, 1 middle, 2 suffix) of the segments of an output."""
        prefix, suffix, middle = self.marks()
        segments = [(prefix, 0), (suffix, 2), (middle, 1)]
        return segments if form == "psm" else [segments[1], segments[0], segments[2]]


def _check(options: Middle) -> None:
    marks = options.marks()
    # Such markers are found where they were put, whatever the texts between them.
    if any(not m or m[:k] == m[-k:] for m in marks for k in range(1, len(m))) or len({m[:1] for m in marks} | {m[-1:] for m in marks}) != 2:
        raise ValueError(f"markers must begin alike and end alike, in another character: {options.markers}")
    if len(set(marks)) != 3 or any(a != b and a in b for a in marks for b in marks):
        raise ValueError(f"markers must differ and not hold each other: {options.markers}")


def _cuts(text: bytes, doc_id: int | None, options: Middle) -> tuple[int, str, int, int]:
    """Number of lines, form, and where prefix and middle end, in bytes."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    n = len(ends)
    digest = hashlib.sha256(f"{options.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = np.frombuffer(digest[:16], ">u4").tolist()
    if not n or any(m in text for m in options.marks()) or h3 % 100 >= options.percent:
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    end_of = lambda k: int(ends[k - 1]) if k else 0
    return n, "spm" if h4 % 100 < options.spm_percent else "psm", end_of(low), end_of(high)


def _chunks(segment: bytes) -> Iterator[bytes]:
    """Whole lines together, as many as fit into a piece; a longer line in several."""
    start = 0
    while len(segment) - start > PIECE_BYTES:
        stop = segment.rfind(b"\n", start, start + PIECE_BYTES) + 1 or start + PIECE_BYTES
        yield segment[start:stop]
        start = stop
    yield segment[start:]


def _characters(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


class _Rows:
    """Rows that are handed on in batches of some size."""

    def __init__(self, schema: str):
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        self.fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size + 64

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [()] * len(self.fields)
        arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, self.fields, strict=True)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in self.fields])


def _cut(options: Middle):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECES)
        for batch in text_slices(batches, "text"):
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = text or b""
                n, form, low, high = _cuts(text, doc_id, options)
                if form == "plain":
                    segments = [text]
                    facts = (doc_id, n, form, None, None)
                else:
                    parts = (text[:low], text[low:high], text[high:])
                    segments = [mark + parts[place] for mark, place in options.order(form)]
                    facts = (doc_id, n, form, _characters(parts[0]), _characters(parts[1]))
                for i, segment in enumerate(segments):
                    for j, piece in enumerate(_chunks(segment)):
                        # The first piece tells the facts.
                        out.add((row, i * SEGMENT + j, piece, *(_NO_FACTS if i or j else facts)), len(piece))
                        if out.size > BATCH_BYTES:
                            yield out.batch()
        yield out.batch()
        give_back()

    return run


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


class _Parser:
    """Cuts an output at its markers while its pieces arrive; gives stretches of the text and their positions."""

    def __init__(self, form: str, options: Middle):
        self.coming = [] if form == "plain" else options.order(form)
        self.place, self.held, self.given = 0, b"", [0, 0, 0]

    def _give(self, piece: bytes) -> tuple[int, bytes]:
        self.given[self.place] += 1
        return self.place * SEGMENT + self.given[self.place], piece

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        data, self.held = self.held + piece, b""
        while self.coming:
            mark, place = self.coming[0]
            at = data.find(mark)
            if at < 0:
                # The end may be the beginning of the marker.
                keep = next((k for k in range(len(mark) - 1, 0, -1) if data.endswith(mark[:k])), 0)
                data, self.held = data[: len(data) - keep], data[len(data) - keep :]
                break
            if at:
                yield self._give(data[:at])
            data, self.place = data[at + len(mark) :], place
            del self.coming[0]
        if data:
            yield self._give(data)

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            yield self._give(self.held)


def _digest_outputs(options: Middle):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_RESTORING)
        row = digest = facts = parser = None

        def close() -> None:
            for position, piece in parser.end():
                out.add((row, position, piece, *_NO_FACTS, None), len(piece))
            # Behind the whole text.
            out.add((row, 3 * SEGMENT, None, *facts, digest.hexdigest()), 64)

        for new, position, piece, *more in _in_order(batches):
            if new != row:
                if row is not None:
                    close()
                row, digest, facts, parser = new, hashlib.sha256(), more, _Parser(more[2], options)
            digest.update(piece)
            for place, stretch in parser.feed(piece):
                out.add((row, place, stretch, *_NO_FACTS, None), len(stretch))
            if out.size > BATCH_BYTES:
                yield out.batch()
        if row is not None:
            close()
        yield out.batch()
        give_back()

    return run


def _digest_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(f"{_FACTS}, output_sha256 string, restored_sha256 string")
    digest = hashlib.sha256()
    for _, _, piece, *facts in _in_order(batches):
        if piece is not None:
            digest.update(piece)
            continue
        out.add((*facts, digest.hexdigest()), 256)
        digest = hashlib.sha256()
        if out.size > BATCH_BYTES:
            yield out.batch()
    yield out.batch()
    give_back()


def _join_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(f"{_FACTS}, output string")
    row, facts, pieces = None, None, []
    for new, _, piece, *more in _in_order(batches):
        if new != row:
            if row is not None:
                out.add((*facts, b"".join(pieces).decode("utf-8", "replace")), sum(map(len, pieces)))
            row, facts, pieces = new, more, []
            if out.size > BATCH_BYTES:
                yield out.batch()
        pieces.append(piece)
    if row is not None:
        out.add((*facts, b"".join(pieces).decode("utf-8", "replace")), sum(map(len, pieces)))
    yield out.batch()
    give_back()


def output_pieces(docs: DataFrame, options: Middle = Middle()) -> DataFrame:
    """Pieces of all outputs, those of a document in one partition and in order of ``position``.

    ``row`` names the document, as ids may repeat; the first piece tells ``doc_id``, the number
    of lines ``n``, the form and the code points of prefix and middle (null if plain).
    """
    _check(options)
    plain = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return plain.mapInArrow(_cut(options), _PIECES).repartition("row").sortWithinPartitions("row", "position")


def fill_in_middle(docs: DataFrame, options: Middle = Middle()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: every document transformed.

    A text of n lines is cut behind two of them, drawn from a hash of seed and id.  ``psm`` puts
    prefix, suffix and middle behind their markers, ``spm`` suffix, prefix and middle; empty texts,
    texts that hold a marker and those outside ``percent`` stay plain.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null text is empty; a null id is
    hashed as no digits at all.  Repeated rows are transformed each.  An empty table gives an empty
    result.
    """
    return output_pieces(docs, options).mapInArrow(_join_outputs, f"{_FACTS}, output string")


def digest_middles(docs: DataFrame, options: Middle = Middle()) -> DataFrame:
    """As ``fill_in_middle``, with digests in place of outputs, which are never whole in memory.

    ``output_sha256`` is that of the output, ``restored_sha256`` that of the text rebuilt from
    output and form; lowercase hex, of UTF-8.
    """
    parsed = output_pieces(docs, options).mapInArrow(_digest_outputs(options), _RESTORING)
    sorted_back = parsed.sortWithinPartitions("row", "position")
    return sorted_back.mapInArrow(_digest_texts, f"{_FACTS}, output_sha256 string, restored_sha256 string")
