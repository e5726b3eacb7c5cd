"""Language identification by unigram models of word pieces, summed over all segmentations.

Each language gives every piece of a fixed public vocabulary a probability.  A word's probability
is the sum over all ways to cut it into pieces, which a forward pass computes; a text's is the
product over its words.  The pieces' probabilities are fitted by expectation maximisation: the
expected number of uses of each piece over all segmentations of the training words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordCache, distinct_words, give_back, text_slices

#: Bounds of the training sample: documents and distinct words of each language.
SAMPLE_DOCS, SAMPLE_WORDS = 2_000, 30_000
#: Longer words, as of languages without spaces, count as runs of so many characters.
RUN = 100
ROUNDS = 4
#: Added to each piece's expected count.
SMOOTHING = 0.05
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TINY = 1e-120
#: Full stops and commas behind a word are words of their own, which spares many distinct words.
_STOPS = ("([a-z])([.,]+)([ \t\n]|$)", "$1 $2$3")


def vocabulary() -> str:
    """The default vocabulary file; another path may be passed instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> list[str]:
    """Pieces of the vocabulary in lower case, a leading space as ``▁``, without duplicates."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
    )
    return sorted({p.lower() for p in ordinary if p})


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Lattice:
    """Pieces at all places of many words at once.

    Piece ``len(pieces)`` is any single character that the vocabulary lacks.
    """

    def __init__(self, pieces: Sequence[str]):
        self.size = len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        # All beginnings of pieces, with the piece that each is or -1.
        known: dict[int, int] = {}
        for n, piece in enumerate(pieces):
            key = 0
            for c in _codes(piece).tolist():
                key = (key * int(_BASE) + c + 1) % 2**64
                known.setdefault(key, -1)
            known[key] = n
        keys = np.array(list(known) or [0], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(known.values()) or [-1], np.int64)[order]

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of words of one length, and a matrix of their characters with ``▁`` in front."""
        marked = ["▁" + w.lower() for w in words]
        lengths = np.array([len(w) for w in marked], np.int64)
        for length in np.unique(lengths):
            places = np.flatnonzero(lengths == length)
            step = max(1, 300_000 // int(length))
            for a in range(0, len(places), step):
                part = places[a : a + step]
                yield part, _codes("".join(marked[i] for i in part)).reshape(len(part), length)

    def pieces(self, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``start, end, rows, ids`` of pieces, by end, for words given as a matrix."""
        begun: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for end in range(1, chars.shape[1] + 1):
            last = chars[:, end - 1] + np.uint64(1)
            begun[end - 1] = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
            for start, (rows, before) in list(begun.items()):
                keys = before * _BASE + last[rows]
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                goes_on = self.keys[at] == keys
                ids = np.where(goes_on, self.ids[at], -1)
                if end - start == 1:
                    yield start, end, rows, np.where(ids >= 0, ids, self.size - 1)
                elif (ids >= 0).any():
                    yield start, end, rows[ids >= 0], ids[ids >= 0]
                # Only words that a piece may still go on in are looked up again.
                if goes_on.any():
                    begun[start] = rows[goes_on], keys[goes_on]
                else:
                    del begun[start]

    def forward(self, chars: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Logarithms of the words' probabilities, one column per column of ``probs``."""
        n, length = chars.shape
        alpha = np.zeros((length + 1, n, probs.shape[1]))
        alpha[0] = 1
        scale = np.zeros((n, 1))
        done = 0
        for start, end, rows, ids in self.pieces(chars):
            if end != done:
                done = end
                # Long words would leave the range of floating point numbers.
                low = alpha[end - 1].max(1) < _TINY
                if low.any():
                    alpha[max(0, end - self.longest) : end, low] /= _TINY
                    scale[low] += np.log(_TINY)
            alpha[end, rows] += alpha[start, rows] * probs[ids]
        return np.log(np.maximum(alpha[length], 1e-300)) + scale

    def expected(self, chars: np.ndarray, probs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words seen ``counts`` times, for one language."""
        n, length = chars.shape
        found = list(self.pieces(chars))
        # A factor per character weighs all segmentations of a word alike; it keeps improbable
        # words in the range of floating point numbers.
        factor = np.ones(n)

        def weights(start: int, end: int, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
            return probs[ids] * factor[rows] ** (end - start)

        def ahead() -> np.ndarray:
            alpha = np.zeros((length + 1, n))
            alpha[0] = 1
            for place in found:
                alpha[place[1], place[2]] += alpha[place[0], place[2]] * weights(*place)
            return alpha

        alpha = ahead()
        low = alpha[length] < 1e-250
        if low.any():
            factor[low] = np.exp(-self.forward(chars[low], probs[:, None])[:, 0] / length)
            alpha = ahead()
        beta = np.zeros((length + 1, n))
        beta[length] = 1
        for place in sorted(found, key=lambda f: -f[0]):
            beta[place[0], place[2]] += beta[place[1], place[2]] * weights(*place)
        share = counts / alpha[length]
        uses = np.zeros(self.size)
        for start, end, rows, ids in found:
            uses += np.bincount(ids, alpha[start, rows] * weights(start, end, rows, ids) * beta[end, rows] * share[rows], self.size)
        return uses


@dataclass
class LanguageModel:
    """Languages, and a column of piece probabilities for each."""

    languages: list[str]
    path: str
    probs: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: the remainder of its id's checksum by 4 is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_languages(docs: DataFrame, path: str | None = None, sample: int = SAMPLE_DOCS) -> LanguageModel:
    """Fit the models on up to about ``sample`` documents of each language, chosen by hash of the id.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; held-out documents and those without
    language or text are not used.  Of each language the ``SAMPLE_WORDS`` most frequent words
    of the sample count; words of more than ``RUN`` characters are cut into runs of so many, here
    and in ``identify``.  Without usable documents the model has no languages.
    """
    path = path or vocabulary()
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counted = usable.groupBy("lang").count()
    chosen = (
        # A row a language, far less than the model's column of probabilities for each.
        usable.join(F.broadcast(counted), "lang")
        .filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(1 << 40) * F.lit(sample) / F.col("count"))
        .select("lang", F.explode(F.split(F.regexp_replace(F.lower("text"), *_STOPS), r"[\x20\x09-\x0D]+")).alias("word"))
        .filter(F.length("word") > 0)
    )
    runs = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{RUN}}}"), F.lit(0))
    chosen = chosen.select("lang", F.explode(F.when(F.length("word") <= RUN, F.array("word")).otherwise(runs)).alias("word"))
    words = chosen.groupBy("lang", "word").count()
    # The list of a language has only the words chosen.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), F.desc("word")))
    words = words.withColumn("turn", turn).filter(F.col("turn") <= SAMPLE_WORDS).withColumn("packed", F.struct(F.col("count"), "word"))
    top = words.groupBy("lang").agg(F.sort_array(F.collect_list("packed"), False).alias("w"))
    rows = sorted(top.collect(), key=lambda r: r["lang"])  # at most SAMPLE_WORDS words a language
    lattice = Lattice(read_pieces(path))
    columns = []
    for row in rows:
        seen = [(w["word"], w["count"]) for w in row["w"]]
        counts = np.array([n for _, n in seen], float)
        groups = list(lattice.groups([w for w, _ in seen]))
        probs = np.full(lattice.size, 1 / lattice.size)
        for _ in range(ROUNDS):
            uses = sum(lattice.expected(chars, probs, counts[at]) for at, chars in groups) + SMOOTHING
            probs = uses / uses.sum()
        columns.append(probs)
    return LanguageModel([r["lang"] for r in rows], path, np.array(columns).T.reshape(lattice.size, len(rows)))


class _Scorer:
    """Word scores of one model in one worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.lattice = Lattice(read_pieces(model.path))
        self.cache = WordCache(self._scores)

    def _scores(self, words: list[str]) -> np.ndarray:
        lowered = [w.lower() for w in words]
        runs = [w[a : a + RUN] for w in lowered for a in range(0, len(w) or 1, RUN)]
        out = np.zeros((len(runs), len(self.model.languages)))
        for places, chars in self.lattice.groups(runs):
            if chars.shape[1] > 1:  # the empty word stays at 0
                out[places] = self.lattice.forward(chars, self.model.probs)
        if len(runs) == len(words):
            return out
        counts = np.array([max(1, -(-len(w) // RUN)) for w in lowered])
        return np.add.reduceat(out, np.cumsum(counts) - counts)

    def posteriors(self, texts: pa.Array) -> np.ndarray:
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), _STOPS[0], _STOPS[1].replace("$", "\\"))
        words, at, starts = distinct_words(plain)
        rows = self.cache.rows_of(words)
        self.cache.parts = [np.concatenate(self.cache.parts or [np.zeros((0, len(self.model.languages)))])]
        values = self.cache.parts[0][rows]
        total = np.stack(
            [np.bincount(np.repeat(np.arange(len(texts)), np.diff(starts)), values[at, k], len(texts)) for k in range(values.shape[1])], 1
        )
        likely = np.exp(total - total.max(1, keepdims=True))
        return likely / likely.sum(1, keepdims=True)


def _predict(model: LanguageModel, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in text_slices(batches, text):
            scorer = scorer or _Scorer(model)
            get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            share = scorer.posteriors(get(text))
            best = share.argmax(1)
            lettered = get("__lettered").to_numpy(zero_copy_only=False)
            names = np.array([*model.languages, UNKNOWN], object)
            score = np.where(lettered, np.round(share[np.arange(len(best)), best], 6), 0.0)
            kept = [n for n in batch.schema.names if n not in ("__text", "__lettered")]
            columns = [get(n) for n in kept]
            columns += [pa.array(names[np.where(lettered, best, len(names) - 1)], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])
        del scorer
        give_back()

    return run


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``held_out, lang_pred, score`` of every document, behind the columns ``keep``.

    Only the text is used, and ``doc_id`` for ``held_out``.  ``score`` is the share of the
    predicted language in the sum of all languages' probabilities of the text.  Texts that are
    null or have no letter, and all texts if the model has no languages, are ``und`` with score
    0.  Repeated rows each get a row.  Columns that are not kept are ignored; a kept one with
    the name of a result is an error.
    """
    clash = {"held_out", "lang_pred", "score"} & set(keep)
    if clash:
        raise ValueError(f"cannot keep columns named like results: {sorted(clash)}")
    kept = docs.select(*keep, held_out(F.col("doc_id")).alias("held_out"))
    if not model.languages:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__lettered")
    # A text that is kept travels once.
    text = "text" if "text" in keep else "__text"
    extra = [lettered] if text in keep else [lettered, F.col("text").cast("string").alias(text)]
    rows = docs.select(*keep, held_out(F.col("doc_id")).alias("held_out"), *extra)
    return rows.mapInArrow(_predict(model, text), kept.schema.add("lang_pred", "string").add("score", "double"))
