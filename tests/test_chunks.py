"""Decoding, word healing and resizing of chunk streams."""

import random
from itertools import accumulate, islice

import pytest
from pyspark.sql import functions as F

from tests import sequential
from textmill.functions.tokens import WordTokenizer, register_tokenizer, resize_external
from textmill.operators.decode import decode_array, decode_chunks, number_islands
from textmill.operators.ordered import PART_ORDER, StreamOrder
from textmill.operators.resize import resize_chunks, resize_text
from textmill.operators.words import heal_array, heal_words

BLOCKS = StreamOrder(block_rows=2, fold_rows=3)
SPLITS = [
    (c[:i], c[i:])
    for c in [bytes.fromhex(h) for h in "C280 DFBF E0A080 EFBFBF F0908080 F48FBFBF".split()]
    for i in range(1, len(c))
]


def frame(spark, streams, payload):
    """streams: lists of (payload, start); the end follows from the size."""
    rows = []
    for s, chunks in enumerate(streams):
        for i, (value, start) in enumerate(chunks):
            size = len(value.encode()) if isinstance(value, str) else len(value)
            value = value if isinstance(value, str) else bytearray(value)
            rows.append((f"s{s}", 0, i, value, start, start + size))
    kind = "string" if payload == "text" else "binary"
    schema = f"object_id string, part_start bigint, seq bigint, {payload} {kind}, start bigint, end bigint"
    return spark.createDataFrame(rows, schema)


def streams_of(df, count):
    found = [[] for _ in range(count)]
    for r in sorted(df.collect(), key=lambda r: (r.object_id, r.seq)):
        found[int(r.object_id[1:])].append((r.text, r.start, r.end))
    return found


def from_arrays(df, payload, operator, count):
    """The same streams through the array form of an operator."""
    item = F.struct("seq", payload, "start", "end")
    whole = df.groupBy("object_id").agg(F.array_sort(F.collect_list(item)).alias("c"))
    arrays = F.transform("c", lambda c: F.struct(c[payload].alias(payload), c["start"].alias("start"), c["end"].alias("end")))
    out = whole.select("object_id", F.posexplode(operator(arrays)).alias("seq", "r")).select("object_id", "seq", "r.*")
    return streams_of(out, count)


def adjacent(values, start=0):
    out = []
    for v in values:
        out.append((v, start))
        start += len(v.encode()) if isinstance(v, str) else len(v)
    return out


def test_decode_cases(spark):
    cases = [([(b"north", 40), (b" and south", 45)], [("north", 40), (" and south", 45)])]
    for a, b in SPLITS:
        ch, n = (a + b).decode(), len(a)
        cases += [
            # Cut in two by a chunk end, alone and between other text.
            (adjacent([a, b], 11), [(ch, 11)]),
            (adjacent([b"x" + a, b + b"y" + a, b + b"z"]), adjacent(["x", ch + "y", ch + "z"])),
            # Without its neighbour a half is dropped; the offset of the rest stays.
            ([(b"p" + a, 3), (b + b"q", 500)], [("p", 3), ("q", 500)]),
            ([(b + b"q", 500), (b"r" + a, 7), (a, 80), (b, 80 + n)], [("q", 500), ("r", 7), (ch, 80)]),
            # An empty chunk between both halves changes nothing.
            (adjacent([a, b"", b + b"end"], 6), [(ch + "end", 6)]),
        ]
    cases += [(adjacent([b"\xbf\xbf"]), []), (adjacent([b"\xbf", b"\xbf\xbf"]), [])]
    expected = [[(t, s, s + len(t.encode())) for t, s in e] for _, e in cases]
    df = frame(spark, [c for c, _ in cases], "data")
    assert streams_of(decode_chunks(df, PART_ORDER), len(cases)) == expected
    assert streams_of(decode_chunks(df, BLOCKS), len(cases)) == expected


@pytest.mark.parametrize("chunks", [[b"one \xfe two"], [b"three\xe2\x82", b"four"], [b"z\xbf\xbf\xbf\xbf\xbf"]])
def test_decode_invalid(spark, chunks):
    df = frame(spark, [adjacent(chunks)], "data")
    with pytest.raises(Exception, match="not valid UTF-8"):
        decode_chunks(df, PART_ORDER).collect()
    kept = decode_chunks(df, PART_ORDER, on_invalid="null").filter("text is null").count()
    assert kept == 1


def test_encoding_guard(spark):
    with pytest.raises(NotImplementedError):
        decode_chunks(frame(spark, [[(b"x", 0)]], "data"), PART_ORDER, encoding="latin-1")


def random_bytes_streams(rng, count):
    streams = []
    for _ in range(count):
        data = "".join(rng.choices("ab é—漢𝄞", k=rng.randint(0, 40))).encode()
        chunks, at, shift = [], 0, rng.choice([0, 0, 5])
        while at < len(data):
            size = rng.choice([0, 1, 1, 2, 3, 4, 7, 12])
            chunks.append((data[at : at + size], at + shift))
            at += size
            if rng.random() < 0.15:
                shift += rng.choice([-2, -1, 1, 3])
        streams.append([(d, s) for d, s in chunks if s >= 0])
    return streams


def test_decode_random(spark):
    streams, expected = [], []
    for s in random_bytes_streams(random.Random(1), 400):
        try:
            expected.append(sequential.decode(s))
            streams.append(s)
        except (ValueError, UnicodeDecodeError):
            pass
    assert len(streams) > 150
    df = frame(spark, streams, "data")
    assert streams_of(decode_chunks(df, PART_ORDER), len(streams)) == expected
    assert streams_of(decode_chunks(df, BLOCKS), len(streams)) == expected
    assert from_arrays(df, "data", decode_array, len(streams)) == expected


HEAL_CASES = [
    # A word cut by a chunk end goes to the later chunk, but no further than one without marks.
    (adjacent(["red gre", "en blue. ye", "llow"]), adjacent(["red ", "green blue. ", "yellow"])),
    (adjacent(["a mar", "vel", "lous day."]), adjacent(["a ", "marvel", "lous day."])),
    # Without a neighbour the rest of a word in front goes, and the word left open behind.
    ([("ttle by little, dro", 70), ("ps fall.", 400)], [(" by little, ", 74), (" fall.", 402)]),
    ([("Anna-", 0), ("tree; bush", 12)], [("Anna-", 0), ("; ", 16)]),
    # Nothing but one word stays, nothing but space goes.
    ([("unfinished", 25)], [("unfinished", 25)]),
    (adjacent(["lone", "ly"]), adjacent(["lone", "ly"])),
    (adjacent(["\n \t", "  "], 90), []),
    ([("rest ", 61)], []),
    # A first chunk at 0 keeps its first word; a blank piece goes, its place stays.
    (adjacent(["   up", "on ti", "me!"]), adjacent(["upon ", "time!"], 3)),
]


def test_heal_cases(spark):
    df = frame(spark, [c for c, _ in HEAL_CASES], "text")
    expected = [[(c[0], c[1], c[1] + len(c[0].encode())) for c in e] for _, e in HEAL_CASES]
    assert streams_of(heal_words(df, PART_ORDER), len(HEAL_CASES)) == expected
    assert streams_of(heal_words(df, BLOCKS), len(HEAL_CASES)) == expected


def random_text_streams(rng, count, alphabet, longest=12):
    streams = []
    for _ in range(count):
        start, chunks = rng.choice([0, 0, 9]), []
        for _ in range(rng.randint(0, 12)):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, longest)))
            chunks.append((text, start))
            start += len(text.encode()) + (rng.choice([-1, 2, 40]) if rng.random() < 0.15 else 0)
            start = max(start, 0)
        streams.append(chunks)
    return streams


def test_heal_random(spark):
    streams = random_text_streams(random.Random(2), 400, "ab. é—漢\n\x1c")
    with_end = [[(t, s, s + len(t.encode())) for t, s in c] for c in streams]
    expected = [sequential.heal(c) for c in with_end]
    df = frame(spark, streams, "text")
    assert streams_of(heal_words(df, PART_ORDER), len(streams)) == expected
    assert streams_of(heal_words(df, BLOCKS), len(streams)) == expected
    assert from_arrays(df, "text", heal_array, len(streams)) == expected


def test_resize_random(spark):
    streams = random_text_streams(random.Random(3), 400, "ab. é漢!\n", longest=40)
    expected = [sequential.resize(c, 4, 9) for c in streams]
    df = frame(spark, streams, "text")
    assert streams_of(resize_chunks(df, PART_ORDER, 4, 9), len(streams)) == expected
    assert streams_of(resize_chunks(df, BLOCKS, 4, 9), len(streams)) == expected
    external = from_arrays(df, "text", lambda c: resize_external(c, WordTokenizer(), 4, 9), len(streams))
    assert external == expected


def test_resize_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    for low, high in [(50, 200), (15, 40), (1, 1), (3, 1500)]:
        got = docs.select("doc_id", F.explode(resize_text(F.col("text"), low, high)).alias("r")).select("doc_id", "r.*")
        mine = sorted((r.doc_id, r.start, r.end, r.text) for r in got.collect())
        assert mine == sorted(
            (d.doc_id, s, e, t) for d in docs.collect() for t, s, e in sequential.resize([(d.text, 0)], low, high)
        )


def test_resize_with_vocabulary(spark):
    tiktoken = pytest.importorskip("tiktoken")

    def build():
        ranks = {bytes([i]): i for i in range(256)}
        for pair in [b"th", b"he", b" t", b"the", b" the", b"er", b"in"]:
            ranks[pair] = len(ranks)
        encoding = tiktoken.Encoding("tiny", pat_str=r" ?\w+|\W", mergeable_ranks=ranks, special_tokens={})
        from textmill.functions.tokens import _PlainTextEncoding

        return _PlainTextEncoding(encoding)

    register_tokenizer("tiny", build)
    tokenizer = build()

    def ends(text, a, b):
        return accumulate((len(tokenizer.decode([t])) for t in tokenizer.encode(text[a:b])), initial=a)

    streams = random_text_streams(random.Random(4), 120, ["the", " the", "other", ". ", "inner", "!"], longest=20)
    expected = [sequential.resize(c, 6, 17, token_ends=lambda *s: islice(ends(*s), 1, None)) for c in streams]
    for order in (PART_ORDER, BLOCKS):
        got = resize_chunks(frame(spark, streams, "text"), order, 6, 17, tokenizer="tiny")
        assert streams_of(got, len(streams)) == expected
    whole = random_text_streams(random.Random(11), 3, ["the", " the", "other", ". ", "inner", "!"], longest=400)
    parted, blocked = (
        streams_of(resize_chunks(frame(spark, whole, "text"), order, 6, 17, tokenizer="tiny"), 3) for order in (PART_ORDER, BLOCKS)
    )
    assert parted == blocked
    # A hard cut may split a character, which decodes to replacement characters.
    streams = random_text_streams(random.Random(6), 120, ["the", " the", "é", ". ", "inner", "漢"], longest=20)
    got = streams_of(resize_chunks(frame(spark, streams, "text"), PART_ORDER, 6, 17, tokenizer="tiny"), len(streams))
    for found, chunks in zip(got, streams):
        whole = "".join(t for t, _ in chunks)
        assert all(len(tokenizer.encode(t.replace("\ufffd", ""))) <= 17 for t, _, _ in found)
        assert all(run in whole for t, _, _ in found for run in t.split("\ufffd"))
        assert all(e - s == len(t.encode()) for t, s, e in found)


def test_resize_arguments(spark):
    for low, high in [(0, 5), (6, 5)]:
        with pytest.raises(ValueError):
            resize_text(F.lit("x"), low, high)
    with pytest.raises(ValueError):
        resize_text(F.lit("x"), tokenizer="unheard of")


def test_islands(spark):
    streams = random_text_streams(random.Random(5), 60, "ab ")
    df = frame(spark, streams, "text")
    expected = []
    for chunks in streams:
        island, end, numbers = 0, 0, []
        for text, start in chunks:
            island += start != end
            end = start + len(text.encode())
            numbers.append(island)
        expected.append(numbers)
    for order in (PART_ORDER, BLOCKS):
        got = [[] for _ in streams]
        for r in sorted(number_islands(df, order).collect(), key=lambda r: (r.object_id, r.seq)):
            got[int(r.object_id[1:])].append(r.island)
        assert got == expected
