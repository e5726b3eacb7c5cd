"""The log-structured collection: deltas, compaction, replacements, pruned reads."""

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.retry import Retry
from textmill.plans.ingest import embed_and_upsert, ingest_files
from textmill.plans.options import IngestOptions
from textmill.session import shared_folder
from textmill.sinks import deltas
from textmill.sinks import vectors as vs
from textmill.sinks.deltas import Delta, State, due


def new_path(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def stored(spark, rows):
    return spark.createDataFrame([(i, [float(v)] * 4) for i, v in rows], "id string, vector array<float>")


def contents(df):
    rows = df.collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.vector[0] for r in rows}


def written(store, version):
    system, folder = store._system(), store._at(f"data/version={version}")
    return system.getContentSummary(folder).getLength()


def test_an_upsert_writes_its_batch_alone(spark):
    store = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=16)
    wide = spark.range(60_000).select(F.col("id").cast("string").alias("id"), F.array(*[F.rand(i).cast("float") for i in range(4)]).alias("vector"))
    store.upsert(wide)
    (first,) = {d.version for d in store._published().deltas}
    store.upsert(stored(spark, [(str(i), i) for i in range(20)]))
    second = {d.version for d in store._published().deltas} - {first}
    assert len(second) == 1 and first in {d.version for d in store._published().deltas}
    assert written(store, second.pop()) * 20 < written(store, first)
    assert store.read().count() == 60_000 and contents(store.fetch(stored(spark, [("7", 0)]).select("id"))) == {"7": 7.0}


def test_random_upserts_and_compactions(spark):
    r = random.Random(6)
    store, expected = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=3, fan=3), {}
    for step in range(9):
        batch = {str(r.randrange(40)): r.randrange(1000) for _ in range(r.choice([1, 5, 30]))}
        store.upsert(stored(spark, batch.items()))
        expected |= {k: float(v) for k, v in batch.items()}
        if step == 5:
            store.compact(everything=True)
            assert all(len(d) == 1 for d in store._published().by_bucket().values())
            assert store.count() == len(expected)
        assert contents(store.read()) == expected
    # Layers stay few: each is more than a share of the next older one.
    assert max(len(d) for d in store._published().by_bucket().values()) < 6
    store.vacuum()
    assert contents(store.read()) == expected and store._children("published") == [str(store._published().number)]
    live = {f"version={d.version}" for d in store._published().deltas}
    assert set(store._children("data")) == live


def test_what_is_due():
    layers = lambda *rows: [Delta(0, i, i, n) for i, n in enumerate(rows)]
    assert due(layers(1000, 10, 10, 10), 3) == layers(1000, 10, 10, 10)[1:]
    assert due(layers(1000, 10, 10), 3) == []
    assert due(layers(50, 10, 10, 10), 3) == layers(50, 10, 10, 10)
    assert due(layers(5), 2) == []


def test_a_batch_during_a_compaction_stays(spark):
    path = new_path(spark)
    store, other = (vs.ParquetVectorStore(spark, path, 4, buckets=1, fan=50) for _ in range(2))
    for i in range(3):
        store.upsert(stored(spark, [("a", i), (f"own{i}", i)]))
    publish = store._publish

    def late(state):
        store._publish = publish
        other.upsert(stored(spark, [("a", 9)]))
        return publish(state)

    store._publish = late
    assert store.compact(everything=True)
    assert contents(store.read()) == {"a": 9.0, "own0": 0.0, "own1": 1.0, "own2": 2.0}
    assert len(store._published().deltas) == 2
    # A second compaction of parts that are merged already leaves the collection as it is.
    state = store._published()
    assert State(7, state.deltas).with_merged([[Delta(0, 1, 1, 1)]], 7, 8, {0: 1}) is None


def test_a_shorter_object_leaves_nothing_behind(spark):
    store = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=4, fan=50)
    store.upsert(stored(spark, [("b/x:0-9", 1), ("b/x:9-20", 1), ("b/y:0-5", 1), ("b/x:3:0-4", 1), ("plain", 1)]))
    gone = spark.createDataFrame([("b/x",), ("b/none",), (None,), ("b/x",)], "prefix string")
    store.upsert(stored(spark, [("b/x:0-7", 2)]), replaced=gone)
    kept = {"b/x:0-7": 2.0, "b/y:0-5": 1.0, "b/x:3:0-4": 1.0, "plain": 1.0}
    assert contents(store.read()) == kept and store.count() == 4
    store.upsert(stored(spark, [("b/x:9-20", 3)]))
    assert contents(store.read()) == {**kept, "b/x:9-20": 3.0}
    # Nothing is written in place of an object that is empty now.
    store.upsert(stored(spark, []), replaced=spark.createDataFrame([("b/y",)], "prefix string"))
    del kept["b/y:0-5"]
    store.compact(everything=True)
    assert contents(store.read()) == {**kept, "b/x:9-20": 3.0}
    assert store._published().replaced == () and store.count() == 4


def test_a_fetch_opens_the_buckets_of_its_ids(spark):
    store = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=64)
    store.upsert(stored(spark, [(str(i), i) for i in range(500)]))
    ids = spark.createDataFrame([(str(i),) for i in range(0, 100, 10)], "id string")
    found = store.fetch(ids)
    assert contents(found) == {str(i): float(i) for i in range(0, 100, 10)}
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 10 < len({f.rsplit("/", 2)[1] for f in store.read().inputFiles()})
    many = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    assert store.fetch(many).count() == 500
    assert contents(store.fetch(ids.limit(0))) == {}


def test_the_first_creator_decides(spark):
    path = new_path(spark)
    late = vs.ParquetVectorStore.__new__(vs.ParquetVectorStore)
    exists = vs.ParquetVectorStore._exists

    def then_another(self, name):
        found = exists(self, name)
        late.__class__._exists = exists
        vs.ParquetVectorStore(spark, path, 4)
        return found

    vs.ParquetVectorStore._exists = then_another
    try:
        with pytest.raises(ValueError, match="was created with"):
            late.__init__(spark, path, 8)
    finally:
        vs.ParquetVectorStore._exists = exists


def test_a_service_is_prepared_once_and_patiently(spark, tmp_path):
    calls = []

    def prepare(dimension, indexed):
        calls.append((dimension, indexed))
        if len(calls) < 3:
            raise ConnectionError("not yet")

    store = vs.ClientVectorStore(lambda: lambda rows: None, 4, prepare=prepare, prepare_retry=Retry(5, 0.0, 0.01))
    for s in (store, store.with_batches(3)):
        s.upsert(stored(spark, [("a", 1)]))
    assert calls == [(4, [])] * 3
    with pytest.raises(ValueError):
        store.with_batches(101)
    with pytest.raises(ValueError, match="replace"):
        store.upsert(stored(spark, []), replaced=spark.createDataFrame([], "prefix string"))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("One sentence here. " * 60)
    (tmp_path / "in" / "b.txt").write_text("Another one there! " * 60)
    return tmp_path / "in"


GRADED = T.StructType([T.StructField("at", T.LongType()), T.StructField("where", T.StringType())])


def test_a_job_with_metadata_and_replacement(spark, folder):
    options = IngestOptions(bucket="up", min_tokens=5, max_tokens=30, metadata=GRADED)
    path = new_path(spark)
    metadata = F.struct(F.col("start").alias("at"), F.col("object_id").alias("where"))

    def run():
        store = ingest_files(spark, str(folder), path, options, F.concat(F.lit("v-"), "object_id"), metadata, replace=True)
        return {(r.id, r.metadata["at"], r.metadata["where"]) for r in store.read().collect()}

    first = run()
    assert all(i == f"v-{where}:{at}-{i.rsplit('-', 1)[1]}" for i, at, where in first)
    (folder / "a.txt").write_text("One sentence here. " * 20)
    second = run()
    assert {x for x in first if x[2] == "up/b.txt"} == {x for x in second if x[2] == "up/b.txt"}
    assert 0 < len([x for x in second if x[2] == "up/a.txt"]) < len([x for x in first if x[2] == "up/a.txt"])


def test_arguments_of_jobs(spark, folder):
    with pytest.raises(ValueError, match="metadata"):
        ingest_files(spark, str(folder), new_path(spark), IngestOptions(metadata=GRADED))
    with pytest.raises(ValueError, match="metadata"):
        ingest_files(spark, str(folder), new_path(spark), IngestOptions(), metadata=F.struct(F.lit(1).alias("x")))
    for bad in ({"batch_size": 0}, {"max_concurrent": 0}):
        with pytest.raises(ValueError):
            IngestOptions(**bad)
    with pytest.raises(ValueError, match="batch size"):
        ingest_files(spark, str(folder), new_path(spark), IngestOptions(batch_size=2049))


def test_prefix_and_metadata_per_batch(spark):
    rows = [("o", 0, i, "x" * (i + 1), 10 * i, 10 * i + i + 1) for i in range(7)]
    chunks = spark.createDataFrame(rows, "object_id string, part_start bigint, seq bigint, text string, start bigint, end bigint")
    values = spark.createDataFrame([("o", 0, b, f"p{b}", (b, "w")) for b in range(3)],
                                   "object_id string, part_start bigint, batch bigint, prefix string, metadata struct<at:bigint,where:string>")
    calls = spark.sparkContext.accumulator(0)

    def connect():
        def embed(texts):
            calls.add(1)
            assert len(texts) <= 3
            return [[float(len(t))] for t in texts]

        return embed

    from textmill.operators.embedding import client_provider

    store = vs.ParquetVectorStore(spark, new_path(spark), 1, GRADED, buckets=2)
    provider = client_provider("lengths", 1, connect)
    embed_and_upsert(chunks, store, provider, batch_size=3, max_concurrent=2, per_batch=values)
    found = {r.id: (r.vector[0], r.metadata["at"]) for r in store.read().collect()}
    assert found == {f"p{i // 3}:{10 * i}-{11 * i + 1}": (i + 1.0, i // 3) for i in range(7)}
    with pytest.raises(Exception, match="fewer values"):
        embed_and_upsert(chunks, store, provider, batch_size=2, per_batch=values)


def test_vectors_are_sorted_by_id_only_if_an_id_comes_twice(spark, monkeypatch):
    calls, latest = [], vs.latest_per_id
    monkeypatch.setattr(vs, "latest_per_id", lambda *given: calls.append(1) or latest(*given))
    store = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=3)
    store.upsert(stored(spark, [(str(i), i) for i in range(50)]))
    assert not calls and store.count() == 50
    store.upsert(stored(spark, [("7", 3), ("7", 9), ("7", 9), ("new", 1), ("7", 5)]))
    assert len(calls) == 1
    assert contents(store.read()) == {str(i): float(i) for i in range(50)} | {"7": 9.0, "new": 1.0}
    # What was written first is gone, nobody reads it.
    assert {f"version={d.version}" for d in store._published().deltas} == set(store._children("data"))
    store.upsert(spark.createDataFrame([], stored(spark, [("", 0)]).schema))
    assert store.read().count() == 51


def test_replacements_meet_ids_alone(spark, monkeypatch):
    seen, without = [], deltas.without_replaced
    monkeypatch.setattr(deltas, "without_replaced", lambda rows, gone: seen.append(rows.columns) or without(rows, gone))
    store = vs.ParquetVectorStore(spark, new_path(spark), 4, buckets=1, fan=9)
    store.upsert(stored(spark, [("b/x:0-1", 1), ("b/x:1-2", 2), ("b/y:0-1", 3)]))
    store.upsert(stored(spark, [("b/x:0-1", 4)]), replaced=spark.createDataFrame([("b/x",)], "prefix string"))
    store.upsert(stored(spark, [("b/y:0-1", 5), ("b/x:1-2", 6)]))
    assert contents(store.read()) == {"b/x:0-1": 4.0, "b/x:1-2": 6.0, "b/y:0-1": 5.0}
    assert seen == [["id", "sequence"]]
