"""Move words that chunk boundaries split to the chunk that holds their end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.arrays import let
from textmill.functions.text import WORD_DELIMITERS, has_any, head_run, is_blank, tail_run
from textmill.functions.tokens import CHUNK
from textmill.operators.ordered import StreamOrder, previous_row

_LINK = "struct<end:bigint,tail:string>"


def _link(chunk_text: Column, end: Column, delimiters: str) -> Column:
    """What the next chunk needs to know: where this one ends and its unfinished word.

    The unfinished word holds no delimiter, so it never depends on earlier chunks: the
    operator needs the row before and nothing else.
    """
    tail = F.when(has_any(chunk_text, delimiters), tail_run(chunk_text, delimiters)).otherwise(F.lit(""))
    return F.struct(end.alias("end"), tail.alias("tail"))


def _healed(text: Column, start: Column, own: Column, before: Column, delimiters: str) -> Column:
    """The healed chunk; ``before`` is the link of the row before (NULL for the first).

    Without a neighbour the text before the first delimiter is dropped, and the start
    moves on by its number of characters.
    """
    follows = start == F.coalesce(before["end"], F.lit(0))
    prefix = F.when(follows, F.coalesce(before["tail"], F.lit(""))).otherwise(F.lit(""))
    joined = F.struct(
        F.concat(prefix, text).alias("full"), prefix.alias("prefix"), (~follows & (start > 0)).alias("orphan")
    )

    def cut(j: Column) -> Column:
        size = F.octet_length(j["full"]) - F.octet_length(own["tail"])
        body = F.substring(j["full"].cast("binary"), F.lit(1), size)
        # A first run as long as the text means that there is no delimiter.
        lost = F.when(j["orphan"], head_run(j["full"], delimiters)).otherwise(F.lit(""))
        return let(
            lost,
            lambda head: let(
                (F.octet_length(head) > 0) & (F.octet_length(head) < F.octet_length(j["full"])),
                lambda trim: F.struct(
                    F.when(trim, F.substring(body, F.octet_length(head) + 1, size))
                    .otherwise(body)
                    .cast("string")
                    .alias("text"),
                    F.when(trim, start + F.length(head))
                    .otherwise(start - F.octet_length(j["prefix"]))
                    .cast("bigint")
                    .alias("start"),
                    (own["end"] - F.octet_length(own["tail"])).cast("bigint").alias("end"),
                ),
            ),
        )

    return let(joined, cut)


def _worth_keeping(text: Column) -> Column:
    return (F.octet_length(text) > 0) & ~is_blank(text)


def heal_array(chunks: Column, delimiters: str = WORD_DELIMITERS) -> Column:
    """Heal an ordered array of chunks that is a whole stream by itself."""
    linked = F.transform(
        chunks,
        lambda c: F.struct(
            c["text"].alias("text"), c["start"].alias("start"), _link(c["text"], c["end"], delimiters).alias("link")
        ),
    )

    def heal_all(items: Column) -> Column:
        return F.transform(
            items,
            lambda c, i: let(
                F.when(i > 0, F.get(items, i - 1)["link"]),
                lambda before: _healed(c["text"], c["start"], c["link"], before, delimiters),
            ),
        )

    return F.filter(let(linked, heal_all), lambda c: _worth_keeping(c["text"])).cast(f"array<{CHUNK}>")


def heal_words(df: DataFrame, order: StreamOrder, delimiters: str = WORD_DELIMITERS) -> DataFrame:
    """Heal a stream of text chunks ``(…order, text, start, end)``; blank results are dropped."""
    own = df.withColumn("__link", _link(F.col("text"), F.col("end"), delimiters))
    linked = previous_row(own, order, F.col("__link"), "__before")
    healed = linked.withColumn(
        "__healed",
        _healed(F.col("text"), F.col("start"), F.col("__link"), F.col("__before"), delimiters),
    )
    fields = ("text", "start", "end")
    return (
        healed.withColumns({f: F.col(f"__healed.{f}") for f in fields})
        .drop("__healed", "__link", "__before")
        .filter(_worth_keeping(F.col("text")))
    )
