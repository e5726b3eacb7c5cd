"""Resize text chunks to token bounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import PREFERRED_DELIMITERS
from textmill.functions.tokens import (
    MAX_TOKENS,
    MIN_TOKENS,
    Tokenizer,
    WordTokenizer,
    get_tokenizer,
    is_native,
    no_tokens,
    nothing_left,
    resize_external_fold,
    resize_fold,
    resize_one,
)
from textmill.operators.ordered import StreamOrder, fold_stream


def resize_chunks(
    df: DataFrame,
    order: StreamOrder,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    tokenizer: str | WordTokenizer | Callable[[], Tokenizer] = "words",
    delimiters: str = PREFERRED_DELIMITERS,
    encoding: str = "utf-8",
) -> DataFrame:
    """Resize a stream of text chunks ``(…order, text, start, end)``.

    What stays below the minimum waits for the next chunk and is lost at a gap or at
    the end of the stream.  Outside tokenizers run in Arrow workers, block by block as the
    others do: the state that a block starts from is the tokens left over before it.
    """
    found = get_tokenizer(tokenizer)
    native = is_native(found, delimiters)
    cut, nothing = (resize_fold, nothing_left) if native else (resize_external_fold, no_tokens)
    out = fold_stream(
        df,
        order,
        ["text", "start", "end"],
        nothing(),
        lambda c, s: cut(c, s, found, min_tokens, max_tokens, delimiters),
        guess=lambda first: nothing(first["start"]),
    )
    return out.withColumn("encoding", F.lit(encoding))


def resize_text(
    text: Column,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    tokenizer: str | WordTokenizer | Callable[[], Tokenizer] = "words",
    delimiters: str = PREFERRED_DELIMITERS,
) -> Column:
    """Resize a text that is one chunk from byte 0; gives an array of chunks."""
    chunk = F.struct(
        text.alias("text"), F.lit(0).cast("bigint").alias("start"), F.octet_length(text).cast("bigint").alias("end")
    )
    return resize_one(chunk, get_tokenizer(tokenizer), min_tokens, max_tokens, delimiters)
