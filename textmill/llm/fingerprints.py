"""SimHash fingerprints of texts and the search for near ones, in built-in functions only.

Each word votes once and each pair of neighbouring words three times, with the bits of their
hashes: a set bit for, an unset bit against.  A bit of the fingerprint is set when the votes for
it outweigh those against.  The votes of two bits share one 64-bit sum, 32 bits apart, so a word
costs 32 additions per 64 bits of fingerprint.  A string has at most 2**31 - 1 bytes and so
2**30 words; their votes stay below 2**32, so no count runs into its neighbour.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: 64-bit parts of a fingerprint.
PARTS = 2
BITS = 64 * PARTS
WORD_WEIGHT, PAIR_WEIGHT = 1, 3
_SPACE = " \t\n\x0b\f\r"
_LANES = 0x0000000100000001


def _terms(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def simhash(rows: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``key_col, fingerprint`` of each row; keys must be unique.

    The fingerprint is an array of ``PARTS`` longs; all zeros for a text without words.
    """
    words = rows.select(F.col(key_col).alias("key"), _terms(F.col(text_col)).alias("w"))
    following = F.slice("w", F.lit(2), F.size("w"))
    terms = words.select("key", F.explode_outer(F.arrays_zip(F.col("w").alias("a"), following.alias("b"))).alias("t"))
    one, two = F.col("t.a"), F.col("t.b")
    hashed = terms.select(
        "key",
        F.when(one.isNotNull(), F.lit(WORD_WEIGHT)).otherwise(F.lit(0)).cast("long").alias("single"),
        F.when(two.isNotNull(), F.lit(PAIR_WEIGHT)).otherwise(F.lit(0)).cast("long").alias("paired"),
        *[F.xxhash64(one, F.lit(p)).alias(f"one{p}") for p in range(PARTS)],
        *[F.xxhash64(one, two, F.lit(p)).alias(f"two{p}") for p in range(PARTS)],
    )

    def votes(p: int, shift: int) -> Column:
        lane = lambda c: F.shiftrightunsigned(c, shift).bitwiseAND(F.lit(_LANES))
        total = lane(F.col(f"one{p}")) * F.col("single") + lane(F.col(f"two{p}")) * F.col("paired")
        return F.sum(total).alias(f"v{p}_{shift}")

    sums = hashed.groupBy("key").agg(
        F.sum(F.col("single") + F.col("paired")).alias("weight"),
        *[votes(p, shift) for p in range(PARTS) for shift in range(32)],
    )

    def bit_of(p: int, bit: int) -> Column:
        mask = 1 << bit if bit < 63 else -(1 << 63)
        count = F.shiftrightunsigned(f"v{p}_{bit % 32}", bit - bit % 32).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(count * 2 > F.col("weight"), F.lit(mask)).otherwise(F.lit(0)).cast("long")

    part = lambda p: reduce(lambda x, y: x.bitwiseOR(y), [bit_of(p, bit) for bit in range(64)])
    return sums.select(F.col("key").alias(key_col), F.array(*[part(p) for p in range(PARTS)]).alias("fingerprint"))


def hex_fingerprint(fingerprint: Column) -> Column:
    """The fingerprint as text; all zeros for null, which is the text without words."""
    digits = [F.lpad(F.lower(F.hex(fingerprint[p])), 16, "0") for p in range(PARTS)]
    return F.coalesce(F.concat(*digits), F.lit("0" * (BITS // 4)))


def distance(one: Column, other: Column) -> Column:
    """Bits in which two fingerprints differ; null counts as all zeros."""
    zero = F.array(*[F.lit(0).cast("long")] * PARTS)
    one, other = F.coalesce(one, zero), F.coalesce(other, zero)
    return reduce(lambda x, y: x + y, [F.bit_count(one[p].bitwiseXOR(other[p])) for p in range(PARTS)])


def near_fingerprints(queries: DataFrame, rows: DataFrame, radius: int = 3) -> DataFrame:
    """``query_id, fingerprint, distance``: distinct fingerprints within ``radius`` bits.

    Both tables have ``id`` and ``fingerprint``.  The bits are cut into ``radius + 1`` blocks;
    two fingerprints that differ in at most ``radius`` bits agree in a whole block.  A table per
    block, with that block in front, is joined on it, so none is missed.  Equal fingerprints are
    joined once, whatever the number of rows that have them; join the result with ``rows`` to
    get ids.  Null fingerprints take no part.  ``radius`` is below ``BITS // 8``.
    """
    if not 0 <= radius < BITS // 8:
        raise ValueError(f"radius must be between 0 and {BITS // 8 - 1}")
    cuts = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]

    def blocks(df: DataFrame) -> DataFrame:
        bits = F.concat(*[F.lpad(F.bin(F.col("fingerprint")[p]), 64, "0") for p in range(PARTS)])
        distinct = df.filter("fingerprint is not null").select("fingerprint").distinct().withColumn("bits", bits)
        parts = [F.substring("bits", a + 1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        return distinct.select("fingerprint", F.posexplode(F.array(*parts)).alias("table", "front"))

    one = blocks(queries).withColumnRenamed("fingerprint", "asked")
    pairs = one.join(blocks(rows), ["table", "front"]).withColumn("distance", distance(F.col("asked"), F.col("fingerprint")))
    near = pairs.filter(F.col("distance") <= radius).select("asked", "fingerprint", "distance").distinct()
    named = queries.select(F.col("id").alias("query_id"), F.col("fingerprint").alias("asked"))
    return named.join(near, "asked").select("query_id", "fingerprint", "distance")


def in_ranges(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Heads of ranges of ``id`` and the expression of a row's range.

    Ranges have equal width, hold about 1,000 ids if those are dense, and number 20,000 at most.
    ``heads (part, head_id, before)``: the smallest id of each range that has any, and the range
    before it; before the first comes the last.
    """
    ends = rows.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    ranges = min(20_000, max(1, ends["n"] // 1000))
    width = max(1, -(-(high - low + 1) // ranges))
    part = F.coalesce(F.floor((F.col("id") - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("long")
    heads = rows.groupBy(part.alias("part")).agg(F.min("id").alias("head_id"))
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy()))
    return heads.withColumn("before", before), part


def with_next(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``next``: ``value`` of the row with the next larger ``id``; the last's is the first.

    Equal ids stand in order of ``value``, null ids come first; ``value`` is never null.  Each
    range of ids also gets the first row of the following range, so one shuffle is enough.
    """
    heads, part = in_ranges(rows.select("id"))
    rows = rows.withColumn("part", part)
    ghosts = (
        rows.select("part", "id", value)
        # At most one row of three longs for each of 20,001 ranges.
        .join(F.broadcast(heads.withColumnRenamed("part", "p")), F.expr("part = p and id <=> head_id"))
        .groupBy(F.col("before").alias("part"))
        .agg(F.min(value).alias(value))
        .withColumn("ghost", F.lit(True))
    )
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    order = Window.partitionBy("part").orderBy("ghost", F.col("id").asc_nulls_first(), value)
    return both.withColumn("next", F.lead(value).over(order)).filter(~F.col("ghost")).drop("part", "ghost")


def edited_text(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as many characters from the front of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def near_rows(rows: DataFrame, every: int = 100, radius: int = 3) -> DataFrame:
    """``asked, n_near``: of each fingerprint of ids divisible by ``every``, the rows within ``radius`` bits of it.

    The rows that have the fingerprint themselves are among them.
    """
    asked = F.concat_ws(",", F.transform("fingerprint", lambda p: p.cast("string")))
    queries = rows.filter(F.col("id") % every == 0).filter("fingerprint IS NOT NULL")
    queries = queries.select(asked.alias("id"), "fingerprint").distinct()
    counts = rows.groupBy("fingerprint").agg(F.count("*").alias("n"))
    found = near_fingerprints(queries, rows, radius).join(counts, "fingerprint")
    return found.groupBy(F.col("query_id").alias("asked")).agg(F.sum("n").alias("n_near"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null text counts as empty, a
    text without words has the fingerprint zero.  Repeated rows and equal ids each give a row.
    Likeness is the share of equal bits.  ``n_near`` is, for ids divisible by 100 and null for the
    others, the number of other documents whose fingerprint differs in 3 bits at most.
    """
    plain = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    chain = with_next(plain, "text").withColumn("row", F.monotonically_increasing_id())
    edited = edited_text(F.col("text"), F.col("next"))
    measured = chain.select(
        "row", "id", "text", F.length("text").cast("long").alias("n_chars"), edited.alias("edited")
    ).withColumn("sha", F.sha2("edited", 256))
    bodies = measured.select(
        F.struct("row", "id", "n_chars", "sha").alias("about"),
        F.explode(F.array(F.struct(F.lit(0).alias("edit"), "text"), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text")))).alias("v"),
    ).select(F.struct("about", "v.edit").alias("key"), F.col("v.text").alias("body"))
    prints = simhash(bodies, "key", "body")
    of = lambda edit: F.max_by("fingerprint", F.when(F.col("key.edit") == edit, 1))
    rows = staged(
        prints.groupBy("key.about").agg(of(0).alias("fingerprint"), of(1).alias("edited")).select("about.*", "fingerprint", "edited"),
        "prints",
    )
    # A text without words has all zeros; only those are null.
    zero = F.array(*[F.lit(0).cast("long")] * PARTS)
    near = near_rows(rows.select("id", F.coalesce("fingerprint", zero).alias("fingerprint")))
    own = F.concat_ws(",", F.transform(F.coalesce("fingerprint", zero), lambda p: p.cast("string")))
    # The others look for nothing, each under a name of its own, so that no task gathers them.
    asked = F.when(F.col("id") % 100 == 0, own).otherwise(F.concat(F.lit("row"), F.col("row").cast("string")))
    chained = with_next(rows, "fingerprint").withColumn("asked", asked)
    alike = lambda one, other: 1 - distance(F.col(one), F.col(other)) / BITS
    return chained.join(near, "asked", "left").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        hex_fingerprint(F.col("fingerprint")).alias("fingerprint"),
        hex_fingerprint(F.col("edited")).alias("edited_fingerprint"),
        alike("fingerprint", "edited").alias("near_edited"),
        alike("fingerprint", "next").alias("near_next"),
        (F.col("n_near") - 1).alias("n_near"),
    )
