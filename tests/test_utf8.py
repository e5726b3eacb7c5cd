import itertools
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.sequential import tail_start
from textmill.functions import utf8

# Characters at the boundaries of each UTF-8 length.
CHARACTERS = [bytes.fromhex(h) for h in "00 7F C280 DFBF E0A080 EFBFBF F0908080 F48FBFBF".split()]
TRUNCATIONS = [c[:i] for c in CHARACTERS for i in range(1, len(c))]


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    got = rows.select("i", expression(F.col("b")).alias("r")).collect()
    return [bytes(r.r) if isinstance(r.r, (bytearray, bytes)) else r.r for r in sorted(got)]


def test_truncation_point(spark):
    hello = b"Hello, world!"
    cases = (
        [(hello + c, len(hello + c)) for c in CHARACTERS]
        + [(hello + t, len(hello)) for t in TRUNCATIONS]
        + [(t, 0) for t in TRUNCATIONS]
        + [(b"Hello, \xffworld!", 14), (b"\x80\x80\x80", 0), (b"", 0), (b"\x80" * 9, 0)]
    )
    assert column(spark, [c for c, _ in cases], utf8.truncation_point) == [e for _, e in cases]


def test_truncation_point_of_random_bytes(spark):
    rng = random.Random(7)
    pool = [0x41, 0x80, 0x9F, 0xA0, 0xBF, 0xC3, 0xE2, 0xF0, 0xF9, 0xFF]
    values = [bytes(rng.choices(pool, k=n)) for n in range(9) for _ in range(150)]
    assert column(spark, values, utf8.truncation_point) == [tail_start(v) for v in values]


@pytest.mark.parametrize("junk", [b"", b"\x80", b"\x80\xbf\x80", b"\x80" * 7])
def test_strip(spark, junk):
    text = b"text"
    values = [junk + text, text + junk, junk + text + junk, junk]
    assert column(spark, values, utf8.leading_continuation_bytes) == [len(junk), 0, len(junk), len(junk)]
    assert column(spark, values, utf8.trailing_continuation_bytes) == [0, len(junk), len(junk), len(junk)]
    assert column(spark, values, utf8.lstrip_continuation_bytes) == [text, text + junk, text + junk, b""]
    assert column(spark, values, utf8.rstrip_continuation_bytes) == [junk + text, text, junk + text, b""]
    assert column(spark, values, utf8.strip_continuation_bytes) == [text, text, text, b""]


def test_continuation_byte(spark):
    rows = spark.range(256).select("id", utf8.is_continuation_byte(F.col("id")).alias("r")).collect()
    assert all(r.r == (0x80 <= r.id < 0xC0) for r in rows)


def test_validity(spark):
    splits = list(itertools.chain.from_iterable([(c, c[:-1]) for c in CHARACTERS if len(c) > 1]))
    assert column(spark, splits, utf8.is_valid_utf8) == [True, False] * (len(splits) // 2)


def test_continuation_bytes(spark):
    every = bytes(range(256))
    values = [b"", b"text", "é漢\U0001f600".encode(), every * 3, b"\x80" * 9, b"\xc3", b"[^]\n\x85\xbf"]
    expected = [sum(0x80 <= byte < 0xC0 for byte in v) for v in values]
    assert column(spark, values, utf8.continuation_bytes) == expected
    assert spark.range(1).select(utf8.continuation_bytes(F.lit(None).cast("binary")).alias("n")).first().n is None


def test_continuation_bytes_are_counted_without_a_list_of_bytes(spark, tmp_path):
    spark.createDataFrame([(1, "é" * 1000)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counted = queries()["continuation_bytes"](spark, str(tmp_path))
    assert counted.first().n == 1000
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(1, octet_length" not in plan
