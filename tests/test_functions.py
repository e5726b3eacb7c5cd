"""Scalar functions on text and arrays."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textmill.functions import digests
from textmill.functions import text as tx
from textmill.functions.tokens import (
    WordTokenizer,
    decode_external,
    detokenize,
    encode_external,
    get_tokenizer,
    register_tokenizer,
    token_count,
    tokenize,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def first_or_last(text, wanted, start, end, reverse):
    """The place by looking at each character of the slice in turn."""
    places = [i for i in range(len(text))[slice(start, end)] if text[i] in wanted]
    return (places[-1] if reverse else places[0]) if places else -1


@pytest.mark.parametrize("wanted", ["7", "09", "37", "x", ""])
def test_index_any(spark, wanted):
    text = "3709137x0"
    items = F.array(*[F.lit(c) for c in text])
    members = F.array(*[F.lit(c) for c in wanted]).cast("array<string>")
    slices = [(a, b, r) for a in (None, 0, 2, 8) for b in (None, 0, 3, 9, 40) for r in (False, True)]
    by_item = [tx.index_any_item(items, members, *s) for s in slices]
    by_text = [tx.index_any(F.lit(text), wanted, *s) for s in slices]
    expected = [first_or_last(text, wanted, *s) for s in slices]
    assert value(spark, F.array(*[c.cast("int") for c in by_item])) == expected
    assert value(spark, F.array(*[c.cast("int") for c in by_text])) == expected


def test_index_any_of_nothing(spark):
    assert value(spark, tx.index_any(F.lit(""), "a")) == -1
    assert value(spark, tx.index_any_item(F.array().cast("array<int>"), F.array(F.lit(1)))) == -1


def test_delimiter_runs(spark):
    for text in ["", "abc", "a b—c", " ", "—é", "漢 字", "x" * 50_000]:
        places = [i for i, c in enumerate(text) if c in tx.WORD_DELIMITERS]
        head = text[: places[0]] if places else text
        tail = text[places[-1] + 1 :] if places else text
        assert value(spark, tx.head_run(F.lit(text), tx.WORD_DELIMITERS)) == head
        assert value(spark, tx.tail_run(F.lit(text), tx.WORD_DELIMITERS)) == tail


def test_class_of_special_characters(spark):
    special = "]^-\\[&&~𝄞"
    assert value(spark, F.regexp_replace(F.lit("a" + special + "b"), tx.char_class(special), "")) == "ab"


def test_blank(spark):
    df = spark.range(1, 0x3200).select("id", tx.is_blank(_char("id")).alias("b"))
    got = {r.id for r in df.collect() if r.b}
    assert got == {i for i in range(1, 0x3200) if chr(i).isspace()}
    assert value(spark, tx.is_blank(F.lit(""))) is False
    assert value(spark, tx.is_blank(F.lit(" \n　"))) is True
    assert value(spark, tx.is_blank(F.lit(" a "))) is False


def _char(column):
    """The character of a code point below 0x10000, by way of UTF-16."""
    return F.decode(F.unhex(F.lpad(F.hex(column), 4, "0")), "UTF-16BE")


def test_identifiers_and_lines(spark):
    assert value(spark, tx.vector_id(F.lit("b/k"), F.lit(3), F.lit(17))) == "b/k:3-17"
    assert value(spark, tx.single_line(F.lit("a\nb\n"))) == "a b "


def test_tokens(spark):
    text = "Hello, wörld_2! <|endoftext|>"
    assert value(spark, tokenize(F.lit(text))) == [
        "Hello", ",", " ", "wörld", "_", "2", "!", " ", "<", "|", "endoftext", "|", ">",
    ]
    assert value(spark, detokenize(tokenize(F.lit(text)))) == text
    assert value(spark, token_count(F.lit(text))) == 13
    assert value(spark, token_count(F.lit(text), WordTokenizer(r"\p{L}\p{N}_"))) == 11


class Letters:
    def encode(self, text):
        return [ord(c) for c in text]

    def decode(self, tokens):
        return "".join(map(chr, tokens))


def test_external_tokenizer(spark):
    register_tokenizer("letters", Letters)
    factory = get_tokenizer("letters")
    df = spark.createDataFrame([("añ",), ("",)], "t string").withColumn("ids", encode_external(F.col("t"), factory))
    got = df.select("t", "ids", decode_external(F.col("ids"), factory).alias("back")).collect()
    assert all(r.t == r.back for r in got)
    assert [r.ids for r in got] == [[97, 241], []]
    with pytest.raises(ValueError):
        get_tokenizer("nobody")
    assert isinstance(get_tokenizer("words"), WordTokenizer)


@pytest.mark.parametrize("chain", [digests.md5_blocks, digests.plain_blocks])
def test_md5_taken_up_again(chain):
    for size in (0, 1, 55, 56, 63, 64, 65, 119, 120, 128, 1000):
        data = bytes(i * 7 % 251 for i in range(size))
        value, whole = digests.START, size - size % digests.BLOCK
        for start in range(0, whole, 2 * digests.BLOCK):
            value = chain(value, data[start : min(start + 2 * digests.BLOCK, whole)])
        assert digests.md5_end(value, data[whole:], size, chain) == hashlib.md5(data).hexdigest()
    with pytest.raises(ValueError):
        digests.md5_blocks(digests.START, b"no block")
