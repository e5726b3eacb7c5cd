"""Bytes to text, healing characters that chunk boundaries split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import utf8
from textmill.functions.arrays import fold_with_output, let
from textmill.functions.tokens import CHUNK
from textmill.operators.ordered import StreamOrder, count_breaks, fold_stream

_INVALID = "chunk is not valid UTF-8"


def check_encoding(encoding: str) -> None:
    """Only UTF-8 chunks can be healed."""
    if encoding.lower() != "utf-8":
        raise NotImplementedError(f"split characters are healed in UTF-8, not in {encoding}")


def no_carry() -> Column:
    """The state before the first chunk of a stream: expected start and carried bytes."""
    return F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(b"").alias("carry"))


def _decode_step(s: Column, chunk: Column, on_invalid: str) -> Column:
    """One chunk ``(data, start)`` on top of a state; gives ``struct(state, out)``."""
    if on_invalid not in ("fail", "null"):
        raise ValueError("on_invalid must be 'fail' or 'null'")
    none = F.array().cast(f"array<{CHUNK}>")
    bad = F.raise_error(F.lit(_INVALID)).cast("string") if on_invalid == "fail" else F.lit(None).cast("string")
    follows = chunk["start"] == s["start"] + F.octet_length(s["carry"])
    joined = F.struct(
        F.when(follows, s["start"]).otherwise(chunk["start"]).alias("start"),
        F.when(follows, F.concat(s["carry"], chunk["data"]))
        .otherwise(utf8.lstrip_continuation_bytes(chunk["data"]))
        .alias("data"),
    )

    def text_of(data: Column) -> Column:
        text = data.cast("string")
        return F.when(F.is_valid_utf8(text), text).otherwise(bad)

    def split(j: Column, cut: Column) -> Column:
        # No cut means too many continuation bytes: the whole value is undecodable.
        size = F.octet_length(j["data"])
        stop = F.coalesce(cut, size)
        end = (j["start"] + stop).cast("bigint")
        carry = utf8.byte_range(j["data"], stop, size - stop)
        text = text_of(utf8.byte_range(j["data"], 0, stop))
        emitted = F.array(F.struct(text.alias("text"), j["start"].alias("start"), end.alias("end")))
        return F.struct(
            F.struct(end.alias("start"), carry.alias("carry")).alias("state"),
            F.when(stop == 0, none).otherwise(emitted).alias("out"),
        )

    return let(joined, lambda j: let(utf8.truncation_point(j["data"]), lambda cut: split(j, cut)))


def decode_fold(chunks: Column, state: Column, on_invalid: str = "fail") -> Column:
    """Decode ordered chunks ``(data, start, end)``; gives ``struct(state, out)``.

    A chunk that does not continue at the expected byte loses its leading continuation
    bytes.  Its text keeps the start of the chunk all the same, and the byte expected
    next is counted from there, so a neighbour of such a chunk is taken for a stranger.

    ``on_invalid="fail"`` fails the job; ``"null"`` emits the range with NULL text.
    """
    return fold_with_output(chunks, state, lambda s, chunk: _decode_step(s, chunk, on_invalid), CHUNK)


def decode_array(chunks: Column, on_invalid: str = "fail") -> Column:
    """Decode an ordered array of chunks that is a whole stream by itself."""
    return decode_fold(chunks, no_carry(), on_invalid)["out"]


def decode_one(data: Column, start: Column, on_invalid: str = "fail") -> Column:
    """Decode a single chunk that is a whole stream by itself; gives an array of chunks."""
    chunk = F.struct(data.alias("data"), start.alias("start"))
    return let(chunk, lambda c: _decode_step(no_carry(), c, on_invalid))["out"]


def decode_chunks(
    df: DataFrame, order: StreamOrder, encoding: str = "utf-8", on_invalid: str = "fail"
) -> DataFrame:
    """Decode a stream of byte chunks ``(…order, data, start, end)`` to text chunks."""
    check_encoding(encoding)
    out = fold_stream(
        df,
        order,
        ["data", "start", "end"],
        no_carry(),
        fold=lambda c, s: decode_fold(c, s, on_invalid),
        probe=lambda c, s: decode_fold(c, s, "null"),
        guess=lambda first: F.struct(first["start"].alias("start"), F.lit(b"").alias("carry")),
    )
    return out.withColumn("encoding", F.lit(encoding))


def number_islands(df: DataFrame, order: StreamOrder, name: str = "island") -> DataFrame:
    """Number the runs of chunks that continue each other byte for byte."""
    return count_breaks(df, order, "start", "end", name)
