"""Every registered query beside its SQL, and what registration promises."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from check import compare

# Queries over the tables as files, which SQL cannot name.
WITHOUT_SQL = {"file_read", "file_sizes", "file_part_reads"}


def test_registration():
    assert set(ORACLE) == set(QUERIES) - WITHOUT_SQL
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).columns == ["object_id", "part_start", "seq", "text", "start", "end"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    verdict = compare(spark, sf, name)
    assert verdict.startswith("rows" if name in WITHOUT_SQL else "equal"), verdict


def test_files_cover_the_tables(spark, sf):
    sizes = {r.object_id: r.length for r in queries()["file_sizes"](spark, sf).collect()}
    parts = queries()["file_part_reads"](spark, sf).collect()
    assert {o: sum(p.end - p.start for p in parts if p.object_id == o) for o in sizes} == sizes
