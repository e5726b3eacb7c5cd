"""Near-duplicates by DartMinHash signatures and banded joining.

A text is the multiset of its runs of five words.  Over each occurrence of a run lies a region of
one unit of weight and endless rank, into which hashed darts are thrown, one per unit of area on
average; a dart has a rank and a coordinate of the signature.  The signature keeps, for each
coordinate, the dart of lowest rank.  Two texts agree in a coordinate with the probability of
their weighted Jaccard similarity.  Ranks are opened in strips, each twice as wide, until every
coordinate has a dart, so a text costs about the same few thousand darts whatever its length.

Coordinates are joined in bands.  Texts that share a band meet one hub, the smallest of them, and
links are confirmed on the words themselves; those that are not like it meet a second hub, the
smallest of theirs.  What no links connect with the first hub even then is compared with all texts of the band that have
another root.  Equal texts are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .blocks import joined, mixed
from .common import give_back, release, staged, text_slices
from .components import components
from .factors import Words

SHINGLE = 5
#: Texts at 0.8 similarity miss each other in all bands with a probability of 0.001.
BANDS, ROWS = 38, 8
COORDINATES = BANDS * ROWS
#: Similarity as a fraction.
SIMILAR = (4, 5)
#: Width of the first strip of ranks; texts of more runs than that have darts in it at once.
_FIRST = 2.0**-8
#: Texts compared with each other at a time.
CHUNK = 128


class Shingles:
    """Runs of words of some texts: ``runs`` and the text of each, and a hash of each text's words."""

    def __init__(self, texts: pa.Array, with_runs: bool = True):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        words = Words(SimpleNamespace(text=data, starts=bounds[:-1], ends=bounds[1:]))
        first, self.n_words = words.first, words.count
        # A text is the sum of a random value for each word and place.
        place = np.arange(1, len(words.hashes) + 1) - np.repeat(first, self.n_words)
        sums = np.zeros(len(place) + 1, np.uint64)
        np.cumsum(mixed(words.hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
        whole = sums[first + self.n_words] - sums[first] + self.n_words.astype(np.uint64)
        self.nodes = mixed(whole)
        if not with_runs:
            return
        runs = joined(words.hashes, SHINGLE)
        inside = np.flatnonzero(words.doc[: len(runs)] == words.doc[SHINGLE - 1 :]) if len(runs) else np.zeros(0, np.int64)
        # A text of fewer words is one run of all it has.
        short = np.flatnonzero((self.n_words > 0) & (self.n_words < SHINGLE))
        doc = np.concatenate([words.doc[inside], short])
        runs = np.concatenate([runs[inside], self.nodes[short]])
        order = np.lexsort((runs, doc))
        self.doc, self.runs = doc[order], runs[order]

    def cells(self) -> np.ndarray:
        """A hash for each occurrence: the first of a run, the second, and so on."""
        new = np.ones(len(self.runs), bool)
        new[1:] = (self.runs[1:] != self.runs[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        turn = np.arange(len(self.runs)) - np.repeat(first, np.diff(np.append(first, len(self.runs))))
        return mixed(self.runs + turn.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _poisson_steps(rate: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts."""
    k = np.arange(int(rate + 12 * rate**0.5 + 20))
    logs = k * np.log(rate) - rate - np.array([lgamma(x + 1) for x in k])
    return np.cumsum(np.exp(logs))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(doc: np.ndarray, cells: np.ndarray, n_docs: int) -> np.ndarray:
    """The darts kept per text and coordinate; texts without cells have zeros."""
    kept = np.zeros(n_docs * COORDINATES, np.uint64)
    filled = np.zeros(n_docs * COORDINATES, bool)
    strip, low, high = 0, 0.0, _FIRST
    while len(cells):
        area = mixed(cells ^ np.uint64((strip + 1) * 0x9FB21C651E98DF25 % 2**64))
        thrown = np.searchsorted(_poisson_steps(high - low), _unit(area), side="right")
        region = np.repeat(np.arange(len(cells)), thrown)
        turn = np.arange(len(region)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
        darts = mixed(area[region] + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
        coordinate = ((darts >> np.uint64(32)) * np.uint64(COORDINATES) >> np.uint64(32)).astype(np.int64)
        target = doc[region] * COORDINATES + coordinate
        free = ~filled[target]
        target, darts = target[free], darts[free]
        # The lowest rank is written last and stays.
        order = np.argsort(mixed(darts ^ np.uint64(0x94D049BB133111EB)))[::-1]
        kept[target[order]] = darts[order]
        filled[target] = True
        going = ~filled.reshape(n_docs, COORDINATES).all(1)[doc]
        doc, cells = doc[going], cells[going]
        strip, low, high = strip + 1, high, high * 2
    return kept.reshape(n_docs, COORDINATES)


def band_keys(kept: np.ndarray) -> np.ndarray:
    """A hash per text and band."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(kept), 1))
    for row in kept.reshape(len(kept), BANDS, ROWS).transpose(2, 0, 1):
        keys = mixed(keys ^ row) * np.uint64(0xA0761D6478BD642F)
    return keys


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", 1 << 19):
        found = Shingles(batch.column(batch.schema.get_field_index("text")))
        keys = band_keys(signatures(found.doc, found.cells(), batch.num_rows)).view(np.int64)
        bands = [k if n else [] for k, n in zip(keys, found.n_words.tolist(), strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
                "node": pa.array(found.nodes.view(np.int64)),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            }
        )


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", 1 << 20):
        nodes = Shingles(batch.column(batch.schema.get_field_index("text")), False).nodes.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), *batch.columns], names=["node", *batch.schema.names])


def with_nodes(rows: DataFrame) -> DataFrame:
    """``node`` in front of ``rows``, which need a string ``text``: equal for equal words."""
    schema = StructType([StructField("node", LongType()), *rows.schema.fields])
    return rows.mapInArrow(_name, schema)


def shared_runs(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted multisets."""
    values, first, n = np.unique(one, return_index=True, return_counts=True)
    lows = np.searchsorted(other, values, side="left")
    highs = np.searchsorted(other, values, side="right")
    return int(np.minimum(n, highs - lows).sum())


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted multisets are similar enough."""
    small, large = sorted((len(one), len(other)))
    if small * SIMILAR[1] < large * SIMILAR[0]:
        return False
    common = shared_runs(one, other)
    return common * SIMILAR[1] >= (len(one) + len(other) - common) * SIMILAR[0]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Similar texts are of similar length, so the sizes of one side bound those of the other.
    for batch in text_slices(text_slices(batches, "text", 1 << 19), "hub_text", 1 << 19):
        get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
        sides = []
        for name in ("text", "hub_text"):
            found = Shingles(get(name))
            sides.append(np.split(found.runs, np.searchsorted(found.doc, np.arange(1, batch.num_rows))))
        same = [alike(a, b) for a, b in zip(*sides, strict=True)]
        yield pa.RecordBatch.from_arrays([get("node"), get("hub"), pa.array(same, pa.bool_())], names=["node", "hub", "same"])


def _compare_all(table: pa.Table) -> pa.Table:
    """Links between the texts of one chunk and those of another (or the same) of one band.

    Texts that links connect already, by ``root`` or found here, are not compared: a chunk of n
    texts gives n - 1 links at most.
    """
    left = table.column("left").to_numpy()
    nodes = table.column("node").to_numpy()
    _, label = np.unique(table.column("root").to_numpy(), return_inverse=True)
    found = Shingles(table.column("text").combine_chunks())
    runs = np.split(found.runs, np.searchsorted(found.doc, np.arange(1, len(nodes))))
    lone = bool(table.column("lone")[0].as_py())
    one, other = np.flatnonzero(left), np.flatnonzero(~left)
    out = []
    for i in one.tolist():
        others = one[one > i] if lone else other
        for j in others[label[others] != label[i]].tolist():
            if label[i] != label[j] and alike(runs[i], runs[j]):
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    give_back()
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _judged(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, hub, same`` of pairs ``node, hub``."""
    hub_texts = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    both = pairs.join(texts, "node").join(hub_texts, "hub").select("node", "hub", "text", "hub_text")
    return staged(both.mapInArrow(_compare, "node long, hub long, same boolean"), "judged")


def _same(judged: DataFrame) -> DataFrame:
    return judged.filter("same").select(F.col("node").alias("a"), F.col("hub").alias("b"))


def near_links(docs: DataFrame, signed: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """``a, b``: links between nodes, enough of them to connect all similar texts that share a band.

    Their number is in proportion to the texts.  What was written on the way is added to ``made``.
    """
    made = [] if made is None else made

    def kept(df: DataFrame, name: str) -> DataFrame:
        made.append(staged(df, name))
        return made[-1]

    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = kept(banded.join(hubs, "band").filter("node <> hub"), "bands")
    pairs = met.select("node", "hub").distinct()

    wanted = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()
    named = with_nodes(docs.select("text"))
    texts = kept(named.join(wanted, "node").dropDuplicates(["node"]), "texts")
    first = _judged(pairs, texts)
    made.append(first)

    # Texts that are not like their hub are strangers; the smallest is their hub in turn.
    strangers = met.join(first.filter("not same").drop("same"), ["node", "hub"]).select("band", "node")
    strangers = kept(strangers, "strangers")
    second = strangers.groupBy("band").agg(F.min("node").alias("hub"))
    made.append(_judged(strangers.join(second, "band").filter("node <> hub").select("node", "hub").distinct(), texts))
    stars = components(_same(first).unionByName(_same(made[-1])))
    made.append(stars)
    roots = lambda name: stars.select(F.col("a").alias(name), F.col("b").alias(f"{name}_root"))
    rooted = met.join(roots("node"), "node", "left").join(roots("hub"), "hub", "left")
    root, hub_root = F.coalesce("node_root", "node"), F.coalesce("hub_root", "hub")
    members = kept(rooted.select("band", "node", root.alias("root"), (root == hub_root).alias("settled")), "members")

    # What is apart still is compared with all texts of the band that have another root, in chunks.
    strange = F.when(~F.col("settled"), F.col("node"))
    sizes = members.groupBy("band").agg(
        F.count("*").alias("n"), F.count(strange).alias("strangers"),
        F.min("root").alias("least"), F.max("root").alias("most"),
        # Bands with the same texts and the same strangers need one comparison.
        F.min("node").alias("low"), F.max("node").alias("high"),
        F.sum(F.xxhash64("node", "settled").cast("decimal(38,0)")).alias("all"),
    ).filter("strangers > 0 and least <> most")
    sizes = sizes.groupBy("n", "strangers", "low", "high", "all").agg(F.min("band").alias("band"))
    sizes = sizes.select(
        "band", F.ceil(F.col("strangers") / CHUNK).alias("of"), F.ceil((F.col("n") - F.col("strangers")) / CHUNK).alias("more")
    )
    # Chunks of strangers come first, those of settled texts behind them.
    chunked = members.join(sizes, "band").withColumn(
        "chunk",
        F.when(F.col("settled"), F.col("of") + F.pmod(F.xxhash64("node"), F.col("more"))).otherwise(F.pmod(F.xxhash64("node"), F.col("of"))),
    )
    # Settled texts meet strangers only.
    last = F.when(F.col("settled"), F.col("of")).otherwise(F.col("of") + F.col("more")) - 1
    dealt = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "band", "node", "root", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"),
        (F.col("chunk") <= F.col("other")).alias("left"), (F.col("chunk") == F.col("other")).alias("lone"),
    )
    more = dealt.join(texts, "node").groupBy("band", "x", "y").applyInArrow(_compare_all, "a long, b long")
    return stars.unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, node, class_id, class_size, kept`` of every document.

    A class holds the documents connected by links; a link is a weighted Jaccard similarity of
    0.8 or more between the multisets of runs of five words.  ``class_id`` is the smallest id of
    the class and ``kept`` is true for one row of it, that with the smallest id.  Words are
    compared as they are.  Texts of fewer than five words are one run of all their words; texts
    without words, null ones included, are one class.  Repeated rows are in one class; of rows
    that share the smallest id one is kept.  Null ids are never the smallest unless there is no
    other.  ``node`` is a hash of the words.  Other columns are ignored.
    """
    plain = docs.select("doc_id", F.col("text").cast("string"))
    signed = staged(
        plain.mapInArrow(_sign, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, node long, bands array<long>"),
        "signed",
    )
    made: list[DataFrame] = []
    stars = components(near_links(plain, signed, made)).select(F.col("a").alias("node"), F.col("b").alias("root"))
    for scratch in made:
        release(scratch)
    rows = signed.select("doc_id", "node").join(stars, "node", "left")
    rows = rows.select("doc_id", "node", F.coalesce("root", "node").alias("root"), F.monotonically_increasing_id().alias("row"))
    rows = staged(rows, "classes")
    release(stars)
    release(signed)
    # Smallest id first, then the first row that has it; null ids last.
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = rows.groupBy("root").agg(F.min(place).alias("best"), F.count("*").alias("class_size"))
    classes = classes.select("root", F.col("best.doc_id").alias("class_id"), F.col("best.row").alias("best_row"), "class_size")
    return rows.join(classes, "root").select(
        "doc_id", "node", "class_id", "class_size", (F.col("row") == F.col("best_row")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``, all columns."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))
    # Other columns may have the names of ours; the text travels once.
    others = {c: f"__{i}" for i, c in enumerate(docs.columns) if c != "text"}
    rows = docs.select(F.col("text").cast("string"), *[F.col(f"`{c}`").alias(n) for c, n in others.items()])
    own = F.col(others["doc_id"])
    found = with_nodes(rows).join(kept, (F.col("node") == F.col("__node")) & own.eqNullSafe(F.col("__id")))
    # Rows may repeat, id and words alike; any one of them stays.
    one = found.dropDuplicates(["__node", "__id"])
    return one.select(*[F.col(others.get(c, c)).alias(c) for c in docs.columns])
