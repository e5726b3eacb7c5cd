from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from textmill.llm.catalog import ORACLE, QUERIES
from textmill.llm.common import staged, table


def plain(rows, columns):
    order = sorted(columns)
    return Counter(tuple(round(v, 9) if isinstance(v := r[columns.index(c)], float) else v for c in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, sf, name):
    found = QUERIES[name](spark, sf)
    db = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert plain(found.collect(), found.columns) == plain(result.fetchall(), columns)


def test_stages_keep_the_columns_and_the_clean_documents(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.dtypes
    extra = docs.selectExpr("*", "1 AS size", "2 AS node", "3 AS score", "4 AS kept", "5 AS carried", "6 AS row")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        extra = staged(stage(spark, extra, sf), name)
        if name != "packing":
            assert [c for c in extra.dtypes if c in columns] == columns and len(extra.columns) == len(columns) + 6
        counts.append(extra.count())
    assert counts[0] >= 0.97 * docs.count() and 0 < counts[2] <= counts[1] <= counts[0]


def test_the_pipeline_takes_an_empty_table(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), name)
        assert docs.count() == 0
