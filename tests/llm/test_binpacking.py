import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.llm.binpacking import Limits, Packer, pack_examples
from textmill.llm.packing import vocabulary

DOCS = "doc_id long, text string"


def check_packing(pieces, size, free, limits):
    """Every token once, in order, within all limits, without padding."""
    filled, spans = defaultdict(list), defaultdict(list)
    for p in pieces:
        filled[p.sequence].append(p)
        spans[p.example].append((p.start, p.length))
    for example, n in enumerate(size):
        at = 0
        for start, length in sorted(spans[example]):
            assert start == at and length > 0
            at += length
        assert at == n
    for parts in filled.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        bears = sum(p.start + p.length - max(p.start, min(free[p.example], p.start + p.length)) for p in parts)
        assert len(parts) <= limits.segments and bears <= limits.loss
        assert at == limits.tokens or (at < limits.tokens and at & (at - 1) == 0)
    return len(filled)


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 40), Limits(100, 100, 1), Limits(1, 1, 1), Limits(50, 2, 50)])
def test_packing_keeps_all_limits(limits):
    r = np.random.default_rng(5)
    size = r.integers(1, 200, 700)
    size[::90] = 5000
    free = np.minimum(size, r.integers(0, 60, 700))
    pieces, placed = Packer(limits).run(size, free, True)
    assert (placed == size).all()
    sequences = check_packing(pieces, size, free, limits)
    if limits == Limits():
        # Close to what the tokens alone need, and few examples are cut.
        assert sequences <= size.sum() / limits.tokens * 1.01 + 12
        assert len(pieces) < 2.2 * len(size)


def test_the_largest_dot_product_comes_first():
    # Room for loss is scarce: after the first, the example that bears none fits better than a longer one.
    limits = Limits(100, 10, 50)
    pieces, _ = Packer(limits).run(np.array([60, 45, 40]), np.array([10, 0, 40]), True)
    assert [(p.example, p.length) for p in pieces[:2]] == [(0, 60), (2, 40)]


def test_limits_must_leave_room():
    with pytest.raises(ValueError):
        Packer(Limits(10, 0, 10))


def test_pieces_hold_the_ids_of_the_texts(spark):
    texts = ["Hello, World! it's a test. ", "", None, "words " * 3000, "Ünï 日本 x1 <|endoftext|>", "a"] + [f"line {i}\n" * (i % 50) for i in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS start", "'x' AS prompt", "2 AS ids").repartition(3)
    limits = Limits(256, 8, 240)
    found = pack_examples(docs, limits, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(vocabulary())
    expected = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
    parts, filled = defaultdict(list), defaultdict(list)
    for r in found:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        parts[r["doc_id"]].append(r)
        filled[r["sequence_id"]].append(r)
    rebuilt = []
    for own in parts.values():
        rest = sorted(own, key=lambda r: r["start"])
        while rest:
            ids = []
            while not ids or ids[-1] != 1:
                nxt = next(r for r in rest if r["start"] == len(ids))
                rest.remove(nxt)
                ids += nxt["ids"]
                assert nxt["doc_tokens"] >= len(ids)
            assert nxt["doc_tokens"] == len(ids)
            rebuilt.append(ids)
    assert sorted(rebuilt) == expected
    for own in filled.values():
        assert len(own) <= 8 and sum(r["loss_tokens"] for r in own) <= 240
        used = sum(r["length"] for r in own)
        assert used == 256 or used & (used - 1) == 0
        assert sorted(r["offset"] for r in own) == np.cumsum([0, *[r["length"] for r in sorted(own, key=lambda r: r["offset"])]])[:-1].tolist()


def test_turns_as_instruction_data(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    answers = turns.filter("role = 'assistant'").join(asked, ["conv_id", "turn"], "left").withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    found = pack_examples(answers, Limits(512, 6, 300), prompt=F.col("asked"), with_ids=True).collect()
    tokenizer = Tokenizer.from_file(vocabulary())
    for r in answers.collect():
        own = sorted((f for f in found if f["doc_id"] == r["doc_id"]), key=lambda f: f["start"])
        ids = [i for f in own for i in f["ids"]]
        prompt, text = (tokenizer.encode(t or "", add_special_tokens=False).ids for t in (r["asked"], r["text"]))
        assert ids == [*prompt, *text, 1] and sum(f["loss_tokens"] for f in own) == len(text) + 1


def test_an_empty_table(spark):
    assert pack_examples(spark.createDataFrame([], DOCS)).collect() == []
