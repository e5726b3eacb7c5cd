"""Offsets, concatenation, batches."""

import re

import pytest
from pyspark.sql import functions as F

from textmill.operators.batching import (
    attach_per_batch,
    collect_batches,
    effective_batch_size,
    number_batches,
)
from textmill.operators.decode import decode_chunks, number_islands
from textmill.operators.ordered import PART_ORDER, StreamOrder, in_order, previous_row, running_sum
from textmill.operators.resize import resize_chunks
from textmill.operators.words import heal_words
from textmill.operators.wrap import wrap_bytes, wrap_bytes_at, wrap_text, wrap_text_at
from textmill.schema import DECODED_CHUNK, ENCODED_CHUNK, chunk_difference, distinct_chunks

ORDERS = [PART_ORDER, StreamOrder(block_rows=2)]
TEXTS = ["Hello, world!", "Foo bar!", "", "Baz qux! 123"]


def raw(spark, texts, kind):
    rows = [("o", 0, i, t if kind == "text" else bytearray(t.encode())) for i, t in enumerate(texts)]
    sql = "string" if kind == "text" else "binary"
    return spark.createDataFrame(rows, f"object_id string, part_start bigint, seq bigint, {kind} {sql}")


def ranges(df):
    return [(r.start, r.end) for r in sorted(df.collect(), key=lambda r: r.seq)]


def expected_from(start, texts):
    out = []
    for t in texts:
        out.append((start, start + len(t.encode())))
        start += len(t.encode())
    return out


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("start", [0, 74])
def test_wrap(spark, order, start):
    for texts in (TEXTS, [], TEXTS[:1], ["é—漢𝄞", "x"]):
        assert ranges(wrap_bytes(raw(spark, texts, "data"), order, start)) == expected_from(start, texts)
        assert ranges(wrap_text(raw(spark, texts, "text"), order, start)) == expected_from(start, texts)


def test_wrap_schema(spark):
    assert [f.name for f in wrap_bytes(raw(spark, TEXTS, "data"), PART_ORDER).schema] == ENCODED_CHUNK.fieldNames()
    assert [f.name for f in wrap_text(raw(spark, TEXTS, "text"), PART_ORDER).schema] == DECODED_CHUNK.fieldNames()


def test_wrap_other_encoding(spark):
    wrapped = wrap_text(raw(spark, ["é𝄞", "ab"], "text"), PART_ORDER, encoding="utf-16le")
    assert ranges(wrapped) == [(0, 6), (6, 10)]


def test_wrap_at(spark):
    starts = [74, 100, 43, 300]
    given = spark.createDataFrame(
        [("o", 0, i, s) for i, s in enumerate(starts)], "object_id string, part_start bigint, seq bigint, start bigint"
    )
    expected = [(s, s + len(t)) for s, t in zip(starts, TEXTS)]
    assert ranges(wrap_bytes_at(raw(spark, TEXTS, "data"), given, PART_ORDER)) == expected
    assert ranges(wrap_text_at(raw(spark, TEXTS, "text"), given, PART_ORDER)) == expected
    for chunks, some in [(raw(spark, TEXTS[:3], "text"), given), (raw(spark, TEXTS, "text"), given.limit(3))]:
        with pytest.raises(Exception, match="same length"):
            wrap_text_at(chunks, some, PART_ORDER).collect()


def test_blocks_agree_with_windows(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("k"), (F.col("id") * F.col("id") % 100_003).alias("seq"), F.col("id").alias("v")
    )
    plain, blocked = (StreamOrder(("k",), "seq", b) for b in (None, 7))
    for add in (running_sum, previous_row):
        one, other = (sorted(add(df, o, F.col("v"), "x").collect(), key=str) for o in (plain, blocked))
        assert one == other


def test_concatenation(spark):
    joined = in_order(ORDERS[1], raw(spark, TEXTS, "text"), raw(spark, ["x", "yz"], "text"), raw(spark, [], "text"))
    wrapped = wrap_text(joined, ORDERS[1])
    assert ranges(wrapped) == expected_from(0, [*TEXTS, "x", "yz"])
    with pytest.raises(Exception, match="must lie in"):
        in_order(PART_ORDER, raw(spark, ["x"], "text").withColumn("seq", F.lit(-1))).collect()


def test_identity(spark):
    df = spark.createDataFrame(
        [("a", 0, 1, "utf-8"), ("a", 0, 1, "ascii"), ("a", 1, 2, "utf-8")],
        "text string, start bigint, end bigint, encoding string",
    )
    assert distinct_chunks(df).count() == 2
    assert chunk_difference(df, df).isEmpty()
    assert [r.surplus for r in chunk_difference(df, distinct_chunks(df)).collect()] == [1]


@pytest.mark.parametrize("order", ORDERS)
def test_batches(spark, order):
    for values, n, expected in [
        ([], 1, []),
        ("abc", 3, ["abc"]),
        ("abcd", 3, ["abc", "d"]),
        ("abc", 2, ["ab", "c"]),
        ("abcdef", 2, ["ab", "cd", "ef"]),
    ]:
        found = collect_batches(raw(spark, list(values), "text"), order, n, ["text"]).collect()
        assert ["".join(i.text for i in r["items"]) for r in sorted(found, key=lambda r: r.batch)] == expected
    with pytest.raises(ValueError):
        number_batches(raw(spark, [], "text"), order, 0)


def test_effective_batch_size():
    assert effective_batch_size(None, 2048, 100) == 100
    assert effective_batch_size(7, 2048, 100) == 7
    for size in (0, 101):
        with pytest.raises(ValueError):
            effective_batch_size(size, 2048, 100)


def test_value_per_batch(spark):
    df = raw(spark, list("abcde"), "text")
    values = spark.createDataFrame(
        [("o", 0, b, f"p{b}") for b in range(3)], "object_id string, part_start bigint, batch bigint, prefix string"
    )
    got = attach_per_batch(df, values, PART_ORDER, 2).collect()
    assert [r.prefix for r in sorted(got, key=lambda r: r.seq)] == ["p0", "p0", "p1", "p1", "p2"]
    with pytest.raises(Exception, match="fewer values"):
        attach_per_batch(df, values.filter("batch < 2"), PART_ORDER, 2).collect()


def test_chains_do_not_run_out_of_positions(spark):
    """Concatenated, decoded, healed, resized and once more: positions stay those of the rows."""
    order = StreamOrder(block_rows=32, fold_rows=32)
    whole = "".join(f"Sentence {i} é漢. " for i in range(24)).encode()
    rows = [("o", 0, 3 * i, whole[7 * i : 7 * i + 7]) for i in range(-(-len(whole) // 7))]
    half = spark.createDataFrame(rows, "object_id string, part_start bigint, seq bigint, data binary")
    stream = wrap_bytes(in_order(order, half, half, half.limit(0), half), order)
    chunks = resize_chunks(heal_words(decode_chunks(stream, order), order), order, 3, 8)
    chunks = resize_chunks(in_order(order, chunks, chunks), order, 1, 3)
    found = sorted(chunks.select("seq", "text").collect())
    assert [r.seq for r in found] == list(range(len(found)))
    assert "".join(r.text for r in found).count("Sentence") > 2 * 3 * 20


def test_positions_past_the_range_of_an_int(spark):
    order = StreamOrder(block_rows=4, fold_rows=2)
    rows = [("o", 0, 2**40 + 5 * i, f"word {i}. ") for i in range(9)]
    df = wrap_text(spark.createDataFrame(rows, "object_id string, part_start bigint, seq bigint, text string"), order)
    found = resize_chunks(df, order, 2, 4).collect()
    assert sorted(r.seq for r in found) == list(range(len(found)))
    whole = resize_chunks(df, PART_ORDER, 2, 4).collect()
    key = lambda r: (r.seq, r.text, r.start, r.end)
    assert sorted(map(key, found)) == sorted(map(key, whole))


def test_chained_operators_read_their_input_once(spark, sf):
    """One scan whatever the chain, and per operator one shuffle of the rows and a few of block summaries."""
    order = StreamOrder(keys=("conv_id",), seq="turn")
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text")
    wrapped = wrap_text(turns, order)
    healed = heal_words(wrapped, order)
    for chain, most in ((wrapped, 4), (healed, 8), (number_islands(healed, order), 14)):
        chain.collect()
        plan = chain._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1
        assert len(re.findall(r"\+- Exchange|:- Exchange", plan)) <= most


def test_streams_without_a_name(spark):
    rows = [(None, None, i, f"w{i} ") for i in range(9)] + [("o", 0, i, "abc") for i in range(5)]
    df = spark.createDataFrame(rows, "object_id string, part_start bigint, seq bigint, text string")
    order = StreamOrder(block_rows=2)
    found = wrap_text(df, order).collect()
    assert sorted((r.start, r.end) for r in found if r.object_id is None) == [(3 * i, 3 * i + 3) for i in range(9)]
    assert sorted(r.start for r in found if r.object_id) == [0, 3, 6, 9, 12]
    assert {r.island for r in number_islands(wrap_text(df, order), order).collect()} == {0}
