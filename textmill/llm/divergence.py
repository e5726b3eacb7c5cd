"""How far the sources of a language are from each other and from the language as a whole.

Chunk factorization: documents are cut at white space into chunks and a chunk's terms are found
once, however often it occurs.  A block of documents keeps the counts of its chunks per document as
packed numbers; its distinct chunks travel, packed by the part of all chunks they belong to, and
each part tokenises every distinct chunk once and answers each block.  The block then counts
distinct documents and occurrences of its terms per language and source and sends them, packed
again, to the part of each term, where rare terms end.

A chunk or term has one entry per block at most, so none gathers more in one place than there are
blocks, and the number of parts follows the bytes of chunks.  Sums over all terms for all pairs of
sources are taken in cells: some of a language's terms by two tiles of its sources.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import shared_folder

from .blocks import with_replies
from .common import distinct_words, give_back, shuffle_partitions, staged, text_slices

#: A term is a run of anything but these: ASCII characters that are no letters.
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
BLOCK_BYTES = 4 << 20
#: Bytes of chunks that a part holds, about.
PART_BYTES = 8 << 20
#: Sources of a tile and rows of a cell, about.
TILE, CELL_ROWS = 256, 200_000

_FACTORED = (
    "block long, chunks string, langs array<string>, sources array<string>, groups binary, sizes binary, codes binary, counts binary"
)
_COUNTED = "part int, terms string, langs array<string>, sources array<string>, term binary, lang binary, source binary, docs binary, n binary"
#: Answer for a chunk that is its only term.
_SAME = "="


def _packed(values: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold the largest; the first byte tells how many."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, np.dtype(f"u{cell[0]}"), offset=1).astype(np.int64)


def _joined(words: pa.Array, ends: np.ndarray) -> pa.Array:
    """Words in lines, as many in a cell as ``ends`` say.  Neither chunks nor terms hold line ends."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.cast(pa.string())), "\n")


def _lines(cells: pa.Array) -> pa.Array:
    return pc.list_flatten(pc.split_pattern(cells.cast(pa.large_string()), "\n"))


def _part_of(words: pa.Array, parts: int) -> np.ndarray:
    hashes = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _by_part(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by part, the parts there are, and where each ends in that order."""
    order = np.argsort(part, kind="stable")
    there, counts = np.unique(part, return_counts=True)
    return order, there, np.cumsum(counts)


def _factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in text_slices(batches, "text", BLOCK_BYTES):
        cell = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
        chunks, at, starts = distinct_words(cell("text"))
        width = max(len(chunks), 1)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(starts))
        pairs, counts = np.unique(doc * width + at, return_counts=True)
        doc, at = np.divmod(pairs, width)
        lang, source = (cell(name).dictionary_encode() for name in ("lang", "source"))
        sources = max(len(source.dictionary), 1)
        codes = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * sources
        codes, group = np.unique(codes + source.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        names = [d.take(pa.array(c)).to_pylist() for d, c in ((lang.dictionary, codes // sources), (source.dictionary, codes % sources))]
        numbers = [_packed(x) for x in (group, np.bincount(doc, minlength=batch.num_rows), at, counts)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                _joined(chunks, np.array([len(chunks)])),
                *[pa.array([x], pa.list_(pa.string())) for x in names],
                *[pa.array([x], pa.binary()) for x in numbers],
            ],
            names=["block", "chunks", "langs", "sources", "groups", "sizes", "codes", "counts"],
        )
        number += 1
        give_back()


def _deal(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunks = _lines(batch.column(1)[row : row + 1])
                order, there, ends = _by_part(_part_of(chunks, parts))
                block = pa.array(np.full(len(there), batch.column(0)[row].as_py()))
                arrays = [pa.array(there), block, _joined(chunks.take(pa.array(order)), ends)]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "block", "chunks"])
            give_back()

    return run


def chunk_terms(chunks: pa.Array) -> pa.Array:
    """The terms of each chunk, joined by spaces."""
    return pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(chunks), NO_TERM, " "))


def _tokenise(table: pa.Table) -> pa.Table:
    """Every distinct chunk of a part once; an answer per block, in the order in which it asked."""
    cells = table.column("chunks").combine_chunks().cast(pa.large_string())
    lists = pc.split_pattern(cells, "\n")
    chunks = lists.flatten().dictionary_encode()
    terms = chunk_terms(chunks.dictionary)
    terms = pc.if_else(pc.equal(terms, chunks.dictionary), _SAME, terms)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    answers = _joined(terms.take(chunks.indices), ends)
    return pa.table({"block": table.column("block"), "part": table.column("part"), "terms": answers})


def _counted(parts: int):
    def rows(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        cell = lambda name: batch.column(batch.schema.get_field_index(name))[row]
        chunks = _lines(batch.column(batch.schema.get_field_index("chunks"))[row : row + 1])
        order, _, _ = _by_part(_part_of(chunks, parts))
        answers = cell("answers").values
        answers = answers.take(pc.array_sort_indices(answers.field("part")))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        found = _lines(answers.field("terms")).take(pa.array(back))
        found = pc.if_else(pc.equal(found, _SAME), chunks, found)
        lists = pc.split_pattern(found, " ")
        terms = lists.flatten().dictionary_encode()
        times = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        # A chunk without terms has an empty one, which no entry may use.
        times[pc.equal(found, "").to_numpy(zero_copy_only=False)] = 0
        offsets = lists.offsets.to_numpy()[:-1].astype(np.int64)
        codes = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)

        size, code, n = (_unpacked(cell(name).as_py()) for name in ("sizes", "codes", "counts"))
        doc = np.repeat(np.arange(len(size)), size)
        more = times[code]
        begins = np.cumsum(more) - more
        term = codes[np.repeat(offsets[code] - begins, more) + np.arange(int(more.sum()))]
        width = max(len(terms.dictionary), 1)
        key, n = np.repeat(doc, more) * width + term, np.repeat(n, more)
        key, n, _ = _summed(key, n)
        # One entry per document and term now; the same once more for group and term.
        key = _unpacked(cell("groups").as_py())[key // width] * width + key % width
        key, n, docs = _summed(key, n)
        group, term = np.divmod(key, width)

        used, term = np.unique(term, return_inverse=True)
        words = terms.dictionary.take(pa.array(used))
        order, there, ends = _by_part(_part_of(words, parts))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_term = np.argsort(place[term], kind="stable")
        term, group, docs, n = place[term][by_term], group[by_term], docs[by_term], n[by_term]
        starts = np.concatenate([[0], ends])
        cuts = np.searchsorted(term, starts)
        langs, sources = cell("langs").values, cell("sources").values
        out = {name: [] for name in ("langs", "sources", "term", "lang", "source", "docs", "n")}
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            for name, all_names in (("lang", langs), ("source", sources)):
                these = all_names.take(pa.array(group[a:b])).dictionary_encode()
                out[f"{name}s"].append(these.dictionary.to_pylist())
                out[name].append(_packed(these.indices.to_numpy(zero_copy_only=False)))
            for name, values in (("term", term[a:b] - starts[i]), ("docs", docs[a:b]), ("n", n[a:b])):
                out[name].append(_packed(values))
        kinds = {"langs": pa.list_(pa.string()), "sources": pa.list_(pa.string())}
        arrays = [pa.array(there), _joined(words.take(pa.array(order)), ends)]
        arrays += [pa.array(values, kinds.get(name, pa.binary())) for name, values in out.items()]
        return pa.RecordBatch.from_arrays(arrays, names=["part", "terms", *out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield rows(batch, row)
                give_back()

    return run


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their sums, and how often they occur."""
    order = np.argsort(key)
    key, begins, times = np.unique(key[order], return_index=True, return_counts=True)
    return key, np.add.reduceat(n[order], begins) if len(begins) else n[:0], times


def _kept(least: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names, codes = {}, {}
        for name, many in (("lang", "langs"), ("source", "sources"), ("term", "terms")):
            column = table.column(many).combine_chunks()
            lists = pc.split_pattern(column.cast(pa.large_string()), "\n") if many == "terms" else column
            found = lists.flatten().dictionary_encode()
            first = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            first = np.concatenate([[0], first[:-1]])
            here = [_unpacked(c) + at for c, at in zip(table.column(name).to_pylist(), first.tolist(), strict=True)]
            codes[name] = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)[np.concatenate(here)]
            names[name] = found.dictionary.cast(pa.string())
        docs, n = (np.concatenate([_unpacked(c) for c in table.column(x).to_pylist()]) for x in ("docs", "n"))
        key = codes["lang"] * len(names["term"]) + codes["term"]
        whole, all_docs, _ = _summed(key, docs)
        _, all_n, _ = _summed(key, n)
        at = np.searchsorted(whole, key)
        stays = np.flatnonzero(all_docs[at] >= least)
        own, n, _ = _summed(at[stays] * len(names["source"]) + codes["source"][stays], n[stays])
        at, source = np.divmod(own, len(names["source"]))
        lang, term = np.divmod(whole[at], len(names["term"]))
        give_back()
        return pa.table(
            {
                "lang": names["lang"].take(pa.array(lang)),
                "source": names["source"].take(pa.array(source)),
                "term": names["term"].take(pa.array(term)),
                "n": pa.array(n, pa.int64()),
                "lang_n": pa.array(all_n[at], pa.int64()),
            }
        )

    return run


def _block_table(blocks: DataFrame) -> DataFrame:
    """Blocks written once, bucketed by their number, so that what comes back for them finds them in place."""
    table = f"textmill_chunks_{uuid.uuid4().hex}"
    path = f"{shared_folder(blocks.sparkSession).rstrip('/')}/{table}"
    writer = blocks.write.bucketBy(shuffle_partitions(blocks.sparkSession), "block")
    writer.option("path", path).option("compression", "zstd").saveAsTable(table)
    return blocks.sparkSession.table(table)


def kept_terms(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, source, term, n, lang_n`` of terms in ``least`` documents of a language, and all ``lang, source``."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    blocks = _block_table(plain.mapInArrow(_factor, _FACTORED))
    size = blocks.agg(F.sum(F.octet_length("chunks"))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), ceil(size / PART_BYTES))
    asked = blocks.select("block", "chunks").mapInArrow(_deal(parts), "part int, block long, chunks string")
    answers = asked.groupBy("part").applyInArrow(_tokenise, "block long, part int, terms string")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "terms")).alias("answers"))
    counted = with_replies(blocks, answers).mapInArrow(_counted(parts), _COUNTED)
    kept = counted.groupBy("part").applyInArrow(_kept(least), "lang string, source string, term string, n long, lang_n long")
    groups = blocks.select(F.explode(F.arrays_zip("langs", "sources")).alias("g")).select(
        F.col("g.langs").alias("lang"), F.col("g.sources").alias("source")
    )
    return staged(kept, "kept"), groups.distinct()


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + kept))``, exact; null where no term is kept."""
    above = f"cast({count} + 1 AS decimal(20,0)) * cast({UNIT} AS decimal(10,0))"
    return F.expr(f"1 + ({above}) div nullif(cast({total} + {kept} AS decimal(20,0)), 0)")


def _cells(table: pa.Table) -> pa.Table:
    """Sums over the terms of one cell for all pairs of sources of its two tiles.

    Rows without a term stand for the sources themselves, so that all of them are there.
    """
    plain = table.filter(pc.is_null(table.column("term"))).sort_by("source")
    sources = plain.column("source").combine_chunks()
    tile, absent = plain.column("tile").to_numpy(), plain.column("absent").to_numpy()
    x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
    rows = table.filter(pc.is_valid(table.column("term")))
    terms = rows.column("term").combine_chunks().dictionary_encode()
    term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    source = pc.index_in(rows.column("source").combine_chunks(), sources).to_numpy(zero_copy_only=False).astype(np.int64)
    p = rows.column("p").to_numpy()
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    used, width = len(terms.dictionary), max(1, (1 << 21) // len(sources))
    total = np.zeros((len(sources), len(sources)), np.int64)
    if used:
        for low in range(0, used, width):
            a, b = np.searchsorted(term, [low, low + width])
            shares = np.repeat(absent[:, None], min(width, used - low), 1)
            shares[source[a:b], term[a:b] - low] = p[a:b]
            for g in range(len(sources)):
                gap = shares[g] - shares
                total[g] += (gap * gap // shares).sum(1)
    # Within a tile all pairs, between two tiles those of different tiles.
    wanted = (tile[:, None] != tile[None, :]) if x != y else ~np.eye(len(sources), dtype=bool)
    one, other = np.nonzero(wanted)
    give_back()
    return pa.table(
        {
            "lang": pa.array([table.column("lang")[0].as_py()] * len(one), pa.string()),
            "source": sources.take(pa.array(one)),
            "item": sources.take(pa.array(other)),
            "p": pa.array(absent[one], pa.int64()),
            "q": pa.array(absent[other], pa.int64()),
            "value": pa.array(total[one, other], pa.int64()),
            "used": pa.array(np.full(len(one), used), pa.int64()),
        }
    )


def _pairs(within: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the sum over all kept terms for each ordered pair of sources."""
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    rows = within.groupBy("lang").agg(F.count("*").alias("rows"))
    shape = sources.join(rows, "lang", "left").select(
        "lang",
        F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"),
        F.ceil(F.coalesce("rows", F.lit(1)) / CELL_ROWS).cast("int").alias("parts"),
    )
    own = groups.select("lang", "source", "absent", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"))
    both = own.unionByName(within.select("lang", "source", "absent", "term", "p")).join(shape, "lang")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    part = F.when(F.col("term").isNotNull(), F.array(F.pmod(F.xxhash64("term"), F.col("parts")).cast("int")))
    dealt = (
        both.withColumn("tile", tile)
        .withColumn("part", F.explode(F.coalesce(part, F.sequence(F.lit(0), F.col("parts") - 1))))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang", "source", "tile", "term", "p", F.coalesce("absent", F.lit(1)).alias("absent"), "part",
            F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"),
        )
    )
    schema = "lang string, source string, item string, p long, q long, value long, used long"
    sums = dealt.groupBy("lang", "part", "x", "y").applyInArrow(_cells, schema)
    whole = sums.groupBy("lang", "source", "item", "p", "q").agg(F.sum("value").alias("value"), F.sum("used").alias("used"))
    kept = groups.groupBy("lang").agg(F.max("kept").alias("kept"))
    # Terms that neither of two tiles has are alike to all pairs of their sources.
    rest = (F.col("kept") - F.col("used")) * F.expr("(p - q) * (p - q) div q")
    return whole.join(kept, "lang").select("lang", "source", "item", (F.col("value") + rest).alias("value"))


def audit_sources(docs: DataFrame, least_documents: int = 3, most_terms: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets each source of a language apart.

    A language keeps the terms found in at least ``least_documents`` of its documents.  ``share``
    is a term's smoothed share in a group ``(lang, source)`` or language, and the divergence of a
    share p from q is floor((p - q)**2 / q).  Part ``pair`` has the other sources of the language
    with the sum over all kept terms, part ``term`` the first ``most_terms`` terms that the group
    has and uses more than its language, with their divergence from it; both ranked by value, then
    by item.

    Needs ``text``, ``lang`` and ``source``, null read as empty; other columns are ignored.  Every
    row is a document, repeated rows too.  A group without terms, or a language that keeps none, has
    pairs alone, of value 0 in the latter.  An empty table gives an empty result.  A document of
    any length is counted as a whole in one block.
    """
    within, groups = kept_terms(docs, least_documents)
    langs = within.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    totals = within.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "kept"])
    groups = staged(groups.withColumn("zero", F.lit(0)).withColumn("absent", share("zero", "total", "kept")).drop("zero"), "groups")
    shares = within.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept"))

    pairs = _pairs(shares, groups)
    own = shares.withColumn("q", share("lang_n", "lang_total", "kept")).filter("p > q")
    terms = own.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= most_terms))
