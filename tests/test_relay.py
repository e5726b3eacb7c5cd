"""Streams whose cuts never fall in step: carried state over many blocks."""

from pyspark.sql import functions as F

from tests import sequential
from textmill.operators.ordered import StreamOrder
from textmill.operators.resize import resize_chunks
from textmill.operators.wrap import wrap_text


def test_periodic_stream(spark):
    """Equal lines keep the phase they start with, so a wrong guess stays wrong."""
    order = StreamOrder(keys=("k",), seq="seq", block_rows=4, fold_rows=5)
    lines = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.lit("word number nine. ").alias("text"))
    got = resize_chunks(wrap_text(lines, order), order, 50, 200)
    text = "word number nine. "
    expected = sequential.resize([(text, i * len(text)) for i in range(300)], 50, 200)
    assert sorted((r.start, r.end, r.text) for r in got.collect()) == sorted((s, e, t) for t, s, e in expected)
