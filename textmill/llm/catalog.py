"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .binpacking import pack_examples
from .common import table
from .divergence import audit_sources
from .extraction import extract_main_text, fit_labeller
from .factors import remove_copied_words
from .fillmiddle import digest_middles
from .fingerprints import fingerprint_edits
from .language import fit_languages, identify
from .mixing import mix_sources
from .neardup import near_duplicates
from .packing import pack_documents
from .revisits import resolve_revisits
from .suffixes import remove_repeated_bytes
from .topk import quantised, top_k


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_labeller(pages))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op4_copied_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_copied_words(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(rows.filter("id % 20 = 0"), rows, 20)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records seen in ``pages``: a response each, and a later revisit each.

    Pages are captures in order of ``page_id``.  A revisit asks for another spelling of the
    address, up to some thousand captures later or earlier, with the validators of its page;
    one in five has another entity tag, one in seven none.
    """
    etag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    field = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    size = F.length("html").cast("string")
    response = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        (F.col("page_id") * 10).alias("time"),
        F.lit("response").alias("kind"),
        F.when(F.col("page_id") % 11 == 0, 503).otherwise(200).alias("status"),
        etag.alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        digest.alias("digest"),
        F.array(
            field("Content-Type", F.lit("text/html")), field("Content-Length", size), field("Cache-Control", F.lit("max-age=60"))
        ).alias("headers"),
    )
    late = F.pmod(F.col("page_id") * 7919, F.lit(4001)) * 10 - 4005
    other = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("#seen"))).otherwise(
        F.regexp_replace("url", "^https?://", "HTTP://www.")
    )
    tag = F.when(F.col("page_id") % 5 == 0, F.lit('"stale"')).when(F.col("page_id") % 7 == 0, None).otherwise(F.concat(F.lit("W/"), etag))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        other.alias("url"),
        (F.col("page_id") * 10 + late).alias("time"),
        F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        tag.alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        digest.alias("digest"),
        F.array(
            field("cache-control", F.lit("max-age=90")), field("Content-Length", F.lit("0")), field("X-Seen", F.col("page_id").cast("string"))
        ).alias("headers"),
    )
    return response.unionByName(revisit)


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_middles(table(spark, sf_dir, "documents"))


def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_examples(table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_repeated_bytes": op3_repeated_bytes,
    "op4_copied_words": op4_copied_words,
    "op5_language": op5_language,
    "op6_top_k": op6_top_k,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_revisits": op10_revisits,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_vector_packing": op12_vector_packing,
    "op13_source_audit": op13_source_audit,
}

ORACLE: dict[str, str] = {
    "op6_top_k": oracle.TOP_K,
    "op9_mixing": oracle.MIXING,
    "op10_revisits": oracle.REVISITS,
    "op11_fill_in_middle": oracle.FILL_IN_MIDDLE,
    "op13_source_audit": oracle.AUDIT,
}
