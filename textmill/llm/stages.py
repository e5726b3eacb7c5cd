"""The operators as stages of a pipeline over documents; columns in, columns out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .factors import factored
from .language import UNKNOWN, fit_languages, identify
from .mixing import mix_sources
from .neardup import drop_near_duplicates
from .packing import pack_documents

#: A document goes if no learned language has this share of the probability.  Words of an unknown
#: language seldom split it evenly, so this rejects few texts; clean ones stay.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, or with no language ahead of all others together, go."""
    # Other columns may have the names of results.
    others = {c: f"__{i}" for i, c in enumerate(docs.columns) if c != "text"}
    rows = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in others.items()])
    judged = identify(rows, fit_languages(docs), keep=("text", *others.values()))
    known = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.select(*[F.col(others.get(c, c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without what they copy from earlier ones; those with nothing left go.

    Texts that lose nothing stay as they are; of the others the words left are joined by spaces.
    ``n_chars`` follows the text.  Documents that had no words stay.
    """
    found = factored(docs, F.struct("*"))
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    columns = [
        F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"carried.`{c}`")).alias(c)
        if c in new
        else F.col(f"carried.`{c}`")
        for c in docs.columns
    ]
    return found.filter((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words"))).select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one on a source's cut is taken whole.

    Documents without words are never taken.
    """
    rows = docs.select("doc_id", "text", "source", F.struct("*").alias("row"))
    mixed = mix_sources(rows, keep=("row",)).filter("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return pack_documents(docs)
