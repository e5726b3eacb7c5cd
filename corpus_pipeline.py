"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept and decides on its own input; all but the
last return the columns of ``documents``.  ``run`` writes each stage to the shared folder and
reads it back, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import stages
from textmill.llm.common import staged, table

STAGES = [
    ("language_id", stages.identify_language),
    ("near_dedup", stages.drop_near_copies),
    ("substring_dedup", stages.drop_repeated_passages),
    ("mixing", stages.mix),
    ("packing", stages.pack),
]

#: Language models, signatures and tokens are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
