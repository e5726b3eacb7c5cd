"""Packing documents into sequences by patterns fitted to the histogram of lengths.

Non-negative least squares decides how often to use each way of filling a sequence with two or
three documents, so that the histogram is used up; the rounded counts are laid out first, and
what they leave is packed by best fit, largest first.  All of that runs on the histogram, which
has as many rows as a sequence has tokens, whatever the number of documents.  Documents find
their place by their rank among those of the same length.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordCache, distinct_words, give_back, staged, text_slices

SEQUENCE = 4096
END_ID = 1
#: Lengths are fitted in steps of so many tokens.
STEP = 4
#: Parts a length is cut into for ranking.
SALTS = 256


def vocabulary() -> str:
    """The default vocabulary file; another path may be passed instead."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible, else one beyond 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_BYTES = _byte_letters()


def _written(word: str) -> str | None:
    """A word as the vocabulary's merges see it, if it is one run of letters that no normalising changes."""
    if not word.isalpha() or word.lower() != word:
        return None
    if word.isascii():
        return word
    if not unicodedata.is_normalized("NFC", word) or "\u03c3" in word or "\u03c2" in word:
        return None
    return word.encode().decode("latin-1").translate(_BYTES)


class _Encoder:
    """Ids of texts.  The vocabulary never joins over white space, so words are encoded once."""

    cached: dict[str, _Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache = WordCache(self._encode)

    @classmethod
    def of(cls, path: str) -> _Encoder:
        if path not in cls.cached:
            cls.cached[path] = cls(path)
        return cls.cached[path]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids.  Plain words go to the merges at once, the others through the whole tokenizer."""
        merge = self.tokenizer.model.tokenize
        ids: list[list[int]] = []
        others: list[int] = []
        for n, word in enumerate(words):
            written = _written(word)
            ids.append([t.id for t in merge(written)] if written else [])
            if written is None:
                others.append(n)
        found = self.tokenizer.encode_batch_fast([words[n] for n in others], add_special_tokens=False)
        for n, one in zip(others, found, strict=True):
            ids[n] = one.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return lengths, np.fromiter((i for own in ids for i in own), "<u4", int(lengths.sum()))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, ``END_ID`` behind each text, and where texts start."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            # Case and the place of a full stop change no ids, but spare many distinct words.
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z])([.,]+)([ \t\n]|$)", r"\1 \2\3")
        words, at, starts = distinct_words(texts)
        rows = self.cache.rows_of(words)
        lengths = np.concatenate([p[0] for p in self.cache.parts] or [np.zeros(0, np.int64)])
        flat = np.concatenate([p[1] for p in self.cache.parts] or [np.zeros(0, "<u4")])
        self.cache.parts = [(lengths, flat)]
        first = np.cumsum(lengths) - lengths
        # One more word, the end id, goes behind each text.
        end = len(lengths)
        lengths, first = np.append(lengths, 1), np.append(first, len(flat))
        flat = np.append(flat, np.array([END_ID], "<u4"))
        used = np.insert(rows[at], starts[1:], end)
        starts = starts + np.arange(len(starts))
        sizes = lengths[used]
        ends = np.cumsum(sizes)
        source = np.repeat(first[used] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return flat[source], np.concatenate([[0], ends])[starts]


def _cut(path: str, sequence: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder.of(path)
        for batch in text_slices(batches, "text"):
            ids, starts = encoder.ids(batch.column(batch.schema.get_field_index("text")))
            lengths = np.diff(starts)
            pieces = -(-lengths // sequence)
            row = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * sequence
            length = np.minimum(lengths[row] - start, sequence)
            begin = starts[row] + start
            raw = memoryview(np.ascontiguousarray(ids)).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            out = {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(row)),
                "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                cells = [ids[a : a + n].astype(np.int32) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                out["ids"] = pa.array(cells, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)
        # The vocabulary stays in the worker, the words of one task do not.
        encoder.cache = WordCache(encoder._encode)
        give_back()

    return run


def cut_pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of each piece."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(_cut(path or vocabulary(), sequence, with_ids), schema)


def _patterns(used: np.ndarray, units: int) -> np.ndarray:
    """Pairs and triples of used lengths, in steps, that fill a sequence; -1 for no third."""
    there = np.zeros(units + 1, bool)
    there[used] = True
    two = used[used <= units // 2]
    pairs = np.stack([two, units - two, np.full(len(two), -1)], 1)[there[units - two]]
    a, b = np.meshgrid(used, used, indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = units - a - b
    fine = (a <= b) & (b <= c)
    a, b, c = a[fine], b[fine], c[fine]
    fine = there[c]
    return np.concatenate([pairs, np.stack([a[fine], b[fine], c[fine]], 1)])


def fit_repeats(counts: np.ndarray, patterns: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeats ``x >= 0`` of patterns that come closest to ``counts`` by squares.

    Accelerated projected gradient; a pattern has three entries at most, so a step is three
    look-ups per pattern.
    """
    slots = np.where(patterns < 0, 0, patterns)
    one = (patterns >= 0).astype(float)
    counts = counts.astype(float).copy()
    counts[0] = 0
    times = lambda x: np.bincount(slots.ravel(), (one * x[:, None]).ravel(), len(counts))
    back = lambda r: (r[slots] * one).sum(1)
    v = np.ones(len(patterns))
    steep = 1.0
    for _ in range(20):
        v = back(times(v))
        steep = float(np.linalg.norm(v)) or 1.0
        v /= steep
    x = look = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, look - back(times(look) - counts) / (1.05 * steep))
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x


def plan_sequences(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """``(repeats, lengths)``: exact lengths that share a sequence, and how many such sequences."""
    left = np.zeros(sequence + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: list[tuple[int, list[int]]] = []
    if left[sequence]:
        plan.append((int(left[sequence]), [sequence]))
        left[sequence] = 0
    units = sequence // STEP
    unit_of = -(-np.arange(sequence + 1) // STEP)
    by_unit = np.bincount(unit_of, left, units + 1).astype(np.int64)
    by_unit[units] = 0  # such a length fills a sequence but for a few tokens
    used = np.flatnonzero(by_unit)
    opened: list[tuple[int, list[int]]] = []
    if len(used):
        patterns = _patterns(used, units)
        fitted = fit_repeats(by_unit, patterns) if len(patterns) else np.zeros(0)
        for p in np.argsort(-fitted, kind="stable"):
            wanted = int(fitted[p] + 0.5)
            if not wanted:
                break
            slots = [int(u) for u in patterns[p] if u >= 0]
            while wanted:
                # The largest lengths left of each step, for as many repeats as they last.
                taken: list[int] = []
                for u in slots:
                    own = [n for n in range(u * STEP, (u - 1) * STEP, -1) if left[n] > taken.count(n)]
                    if not own:
                        break
                    taken.append(own[0])
                if len(taken) < len(slots):
                    break
                n = min(wanted, min(int(left[x]) // taken.count(x) for x in set(taken)))
                for x in taken:
                    left[x] -= n
                opened.append((n, taken))
                wanted -= n
    # Best fit: whatever still has room takes the longest document that fits.
    waiting = opened[::-1]
    while waiting or left.any():
        if waiting:
            n, taken = waiting.pop()
        else:
            largest = int(np.flatnonzero(left)[-1])
            n, taken = int(left[largest]), [largest]
            times = max(1, min(sequence // largest, n))  # several of one length in a sequence
            n, taken = n // times, [largest] * times
            left[largest] -= n * times
        room = sequence - sum(taken)
        fits = np.flatnonzero(left[: room + 1])
        if not len(fits):
            plan.append((n, taken))
            continue
        best = int(fits[-1])
        more = min(n, int(left[best]))
        left[best] -= more
        if more < n:
            waiting.append((n - more, taken))
        waiting.append((more, [*taken, best]))
    return plan


def _slots(plan: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, offset``, by length and rank."""
    rows, ranks, sequence = [], {}, 0
    for n, lengths in plan:
        offset = 0
        for length in lengths:
            rows.append((length, ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + n
            offset += length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _place(slots: np.ndarray):
    keys = slots[:, 0] << 48 | slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            rank = get("rank").astype(np.int64)
            at = np.searchsorted(keys, get("length") << 48 | rank, side="right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``doc_id``, ``piece``, ``length``.

    ``length`` is between 1 and ``sequence``.  Equal rows are packed each.  ``pieces`` is read
    twice, so it should come from files.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # 4,096 rows at most
    slots = _slots(plan_sequences(histogram, sequence))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within)).join(counts, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("rank") - 1 + F.col("first")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_place(slots), f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Tokenise documents, cut those longer than a sequence, and pack the pieces.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null or blank text is the end
    id alone.  Repeated rows are packed each.  An empty table gives an empty result.
    """
    return pack(staged(cut_pieces(docs, path, sequence, with_ids), "pieces"), sequence)
