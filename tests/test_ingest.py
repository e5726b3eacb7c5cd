"""Objects, notifications, embedding, stores, and the jobs built from them."""

import hashlib
import json
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.queries import QUERIES
from tests import sequential
from textmill.operators.embedding import (
    assemble_vectors,
    client_provider,
    embed_chunks,
    get_provider,
    in_input_order,
    register_provider,
)
from textmill.operators.retry import Retry
from textmill.plans.ingest import (
    embed_and_upsert,
    ingest_files,
    parts_of_files,
    parts_of_table,
    prepare_parts,
    quarantined_parts,
)
from textmill.plans.options import IngestOptions
from textmill.session import shared_folder
from textmill.sinks import vectors as vs
from textmill.sources import objects as sources
from textmill.sources.notifications import describe_part, parse_notifications, parse_part
from textmill.sources.objects import (
    chunk_parts,
    cut_parts,
    digest_objects,
    list_objects,
    objects_from_table,
    plan_parts,
    read_objects,
    read_ranges,
    stat_objects,
)
from textmill.streaming.ingest import (
    arriving_notifications,
    arriving_objects,
    parts_of_arriving,
    parts_of_notified,
    start_ingest,
)

TEXT = "Élan vital. " * 40 + "Ωmega — \n" * 30 + "漢字 tail"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"a.txt": TEXT, "b.txt": TEXT[7:], "empty.txt": ""}.items():
        (tmp_path / "in" / name).write_bytes(text.encode())
    return tmp_path / "in"


def by_hand(data, options):
    """The chain over one object, part by part."""
    out = []
    for low in range(0, len(data), options.part_size):
        part = data[low : low + options.part_size]
        chunks = [(part[i : i + options.chunk_size], low + i) for i in range(0, len(part), options.chunk_size)]
        healed = sequential.heal(sequential.decode(chunks))
        resized = sequential.resize([(t, s) for t, s, _ in healed], options.min_tokens, options.max_tokens)
        out += [(low, i, *c) for i, c in enumerate(resized)]
    return out


@pytest.mark.parametrize("part, chunk, low, high", [(1000, 64, 15, 40), (777, 1 << 20, 5, 30), (1 << 20, 5, 50, 200)])
def test_chain(spark, sf, part, chunk, low, high):
    options = IngestOptions(part_size=part, chunk_size=chunk, min_tokens=low, max_tokens=high)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").filter("n_chars < 6000")
    objects = objects_from_table(docs, "d", F.col("doc_id"), F.col("text"))
    got = prepare_parts(parts_of_table(objects, options), options).collect()
    mine = sorted((r.object_id, r.part_start, r.seq, r.text, r.start, r.end) for r in got)
    expected = [
        (f"d/{d.doc_id}", *row) for d in docs.collect() for row in by_hand(d.text.encode(), options)
    ]
    assert mine == sorted(expected)


def test_files(spark, folder):
    listed = {r.object_id: r.length for r in list_objects(spark, str(folder), "up").collect()}
    sizes = {f"up/{f.name}": f.stat().st_size for f in folder.iterdir()}
    assert {k: v for k, v in sizes.items() if v} == {k: v for k, v in listed.items() if v}
    plan = list_objects(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    bodies = {r.object_id: bytes(r.content) for r in read_objects(spark, str(folder), "up").collect()}
    assert bodies["up/a.txt"] == TEXT.encode()


def test_keys_of_nested_files(spark, folder):
    (folder / "sub dir").mkdir()
    (folder / "sub dir" / "a.txt").write_text("inner")
    listed = list_objects(spark, str(folder), "up", recursiveFileLookup="true").collect()
    assert {"up/a.txt", "up/sub dir/a.txt"} <= {r.object_id for r in listed}
    one = list_objects(spark, str(folder / "a.txt"), "up").first()
    assert one.object_id == "up/a.txt"
    parts = parts_of_files(spark, str(folder), IngestOptions(bucket="up"), recursiveFileLookup="true").collect()
    assert {bytes(r.data) for r in parts if r.object_id == "up/sub dir/a.txt"} == {b"inner"}


def test_keys_below_a_pattern(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "a.txt").write_text(f"Only in {name}. " * 20)
    for pattern in ("in/*", "in/{x,y}/a.txt", "in/[xy]/*"):
        listed = {r.object_id for r in list_objects(spark, f"{tmp_path}/{pattern}", "up").collect()}
        assert listed == {"up/x/a.txt", "up/y/a.txt"}
    store = ingest_files(spark, f"{tmp_path}/in/*", new_path(spark), IngestOptions(bucket="up", min_tokens=5, max_tokens=30))
    ids = [r.id for r in store.read().collect()]
    assert len(set(ids)) == len(ids) and {i.split(":")[0] for i in ids} == listed


def test_rows_without_text_or_key(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "c")], "k int, t string")
    held = objects_from_table(rows, "b", F.col("k"), F.col("t"))
    assert {(r.object_id, r.length) for r in held.collect()} == {("b/1", 0), ("b/2", 0), ("b/3", 1)}
    assert [r.object_id for r in parts_of_table(held, IngestOptions()).collect()] == ["b/3"]
    with pytest.raises(Exception, match="without a key"):
        objects_from_table(rows, "b", F.lit(None), F.col("t")).collect()


def test_parts(spark, folder):
    options = IngestOptions(part_size=100, bucket="up")
    data = {f"up/{f.name}": f.read_bytes() for f in folder.iterdir()}
    ranged = {
        (r.object_id, r.start, r.end): bytes(r.data) for r in parts_of_files(spark, str(folder), options).collect()
    }
    assert all(data[o][s:e] == b for (o, s, e), b in ranged.items())
    assert {o for o, _, _ in ranged} == {"up/a.txt", "up/b.txt"}
    assert sum(map(len, ranged.values())) == sum(map(len, data.values()))
    held = cut_parts(read_objects(spark, str(folder), "up"), 100).collect()
    assert {(r.object_id, r.start, r.end): bytes(r.data) for r in held} == ranged
    chunks = chunk_parts(cut_parts(read_objects(spark, str(folder), "up"), 100), 30).collect()
    assert all(data[r.object_id][r.start : r.end] == bytes(r.data) for r in chunks)
    assert max(r.seq for r in chunks) == 3


def test_part_sizes(spark):
    objects = spark.createDataFrame([("o", n) for n in (0, 1, 10, 11)], "object_id string, length bigint")
    got = [(r.length, r.start, r.end) for r in plan_parts(objects, 10).collect()]
    assert sorted(got) == [(1, 0, 1), (10, 0, 10), (11, 0, 10), (11, 10, 11)]
    with pytest.raises(ValueError):
        plan_parts(objects, 0)


def test_part_beyond_two_gigabytes(spark, tmp_path):
    path = tmp_path / "big"
    with open(path, "wb") as f:
        f.truncate(3 << 30)
        f.seek((3 << 30) - 5)
        f.write(b"tail.")
    planned = plan_parts(list_objects(spark, str(path)), 64 << 20)
    assert planned.count() == 48
    last = read_ranges(planned.filter(F.col("end") == 3 << 30)).first()
    assert bytes(last.data[-5:]) == b"tail." and last.start == (3 << 30) - (64 << 20)


@pytest.mark.parametrize("stretch", [64, 192, 1 << 20])
def test_digests_of_files(spark, tmp_path, monkeypatch, stretch):
    bodies = {f"f {n}": bytes(i * 7 % 251 for i in range(n)) for n in (1, 63, 64, 65, 191, 192, 193, 384, 700)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    expected = {f"up/{k}": (len(v), hashlib.md5(v).hexdigest()) for k, v in bodies.items()}
    files, listed = (read(spark, str(tmp_path), "up") for read in (read_objects, list_objects))
    got = digest_objects(files, listed, stretch).collect()
    assert len(got) == len(bodies) and {r.object_id: (r.length, r.digest) for r in got} == expected
    # Where only Spark opens the files, they come as rows.
    monkeypatch.setattr(sources, "_can_seek", lambda path: False)
    assert {r.object_id: (r.length, r.digest) for r in digest_objects(files, listed, stretch).collect()} == expected
    with pytest.raises(ValueError):
        digest_objects(files, listed, 100)


def test_digest_of_a_changed_file(tmp_path):
    (tmp_path / "a").write_bytes(bytes(200))
    file = ("up/a", str(tmp_path / "a"), 200)
    _, value, stamp = sources._digest_stretch(file, sources.START, None, 0, 128)
    assert sources._digest_stretch(file, value, stamp, 128, 128)[1] == hashlib.md5(bytes(200)).hexdigest()
    for other, then in ((file, (200, 0)), (("up/a", file[1], 300), None)):
        with pytest.raises(OSError, match="changed"):
            sources._digest_stretch(other, value, then, 128, 128)


def test_file_beyond_two_gigabytes(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "big.parquet", "wb") as f:
        f.truncate(size)
        f.seek(size - 5)
        f.write(b"tail.")
    (tmp_path / "small.parquet").write_bytes(b"small")
    body = hashlib.md5()
    for _ in range(128):
        body.update(bytes(16 << 20))
    body.update(b"tail.")
    got = {r.object_id: (r.length, r.digest) for r in QUERIES["file_read"](spark, str(tmp_path)).collect()}
    assert got == {
        "tables/big.parquet": (size, body.hexdigest()),
        "tables/small.parquet": (5, hashlib.md5(b"small").hexdigest()),
    }


def message(key, **more):
    return json.dumps({"Records": [{"s3": {"object": {"key": key}}}, {"s3": {"object": {"key": "more"}}}], **more})


def test_notifications(spark):
    bodies = [message("a b"), message("x%2Fy", Event="other"), json.dumps({"Event": "s3:TestEvent"})]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r.object_id for r in parse_notifications(df, "up").collect()} == {"up/a b", "up/x%2Fy"}
    assert "x/y" in {r.key for r in parse_notifications(df, "up", url_decode=True).collect()}
    assert parse_notifications(df, "up", all_records=True).count() == 4
    for bad in ["{}", "no json", '{"Records":[]}']:
        for every in (False, True):
            with pytest.raises(Exception, match="without an object key"):
                parse_notifications(spark.createDataFrame([(bad,)], "body string"), "up", all_records=every).collect()


def test_descriptors(spark):
    df = spark.createDataFrame([('b"', "k/ä\\", 3, 9)], "b string, k string, s bigint, e bigint")
    for wire in (False, True):
        sent = df.select(describe_part(*map(F.col, "bkse"), wire=wire).alias("m"))
        text = json.loads(sent.first().m)
        if wire:
            text = json.loads(text)
        assert text == {"objectId": {"bucket": 'b"', "key": "k/ä\\"}, "start": 3, "end": 9}
        part = sent.select(parse_part(F.col("m"), wire).alias("p")).first().p
        assert (part.objectId.bucket, part.objectId.key, part.start, part.end) == ('b"', "k/ä\\", 3, 9)


def test_quarantine(spark):
    rows = [("good", b"all fine here. " * 9), ("bad", b"broken \xff here. " * 9), ("worse", b"x\x80\x80\x80\x80")]
    df = spark.createDataFrame([(k, len(b), bytearray(b)) for k, b in rows], "object_id string, length bigint, content binary")
    options = IngestOptions(on_invalid="quarantine", min_tokens=2, max_tokens=9)
    parts = parts_of_table(df, options)
    assert {r.object_id for r in quarantined_parts(parts, options).collect()} == {"bad", "worse"}
    assert {r.object_id for r in prepare_parts(parts, options).collect()} == {"good"}
    with pytest.raises(Exception, match="not valid UTF-8"):
        prepare_parts(parts, IngestOptions()).collect()


def test_jobs_report_quarantined_parts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.txt").write_bytes(b"all fine here. " * 9)
    (tmp_path / "in" / "bad.txt").write_bytes(b"broken \xff here. " * 9)
    path, report = str(tmp_path / "in"), str(tmp_path / "report")
    given = dict(bucket="up", on_invalid="quarantine", min_tokens=2, max_tokens=9)
    with pytest.raises(ValueError, match="quarantine_path"):
        ingest_files(spark, path, new_path(spark), IngestOptions(**given))
    options = IngestOptions(**given, quarantine_path=report)
    store = ingest_files(spark, path, new_path(spark), options)
    assert {r.id.split(":")[0] for r in store.read().collect()} == {"up/good.txt"}
    found = [(r.object_id, r.part_start, r.part_end) for r in spark.read.parquet(report).collect()]
    assert found == [("up/bad.txt", 0, (tmp_path / "in" / "bad.txt").stat().st_size)]
    streamed = IngestOptions(**given, quarantine_path=f"{report}-stream")
    start_ingest(
        arriving_objects(spark, path, "up"), lambda b: parts_of_arriving(b, streamed),
        vs.ParquetVectorStore(spark, new_path(spark), 64), get_provider("term-hash-64"), new_path(spark), streamed,
    ).awaitTermination()
    assert [r.object_id for r in spark.read.parquet(f"{report}-stream").collect()] == ["up/bad.txt"]


def chunk_frame(spark, texts):
    rows, at = [], 0
    for i, t in enumerate(texts):
        rows.append(("o", 0, i, t, at, at + len(t.encode())))
        at += len(t.encode())
    return spark.createDataFrame(
        rows, "object_id string, part_start bigint, seq bigint, text string, start bigint, end bigint"
    ).coalesce(1)


def test_embed_and_upsert(spark, tmp_path):
    log = tmp_path / "calls"

    def embedder():
        def embed(texts):
            with open(log, "a") as f:
                f.write(json.dumps(texts) + "\n")
            return [[1.0]] * len(texts)

        return embed

    def writer():
        def write(rows):
            with open(f"{log}.rows", "a") as f:
                f.write(json.dumps(rows) + "\n")

        return write

    provider = client_provider("one", 1, embedder, batch_size=2, max_concurrent=2)
    store = vs.ClientVectorStore(writer, 1, batch_limit=2)
    chunks = chunk_frame(spark, ["hello\n", "world! This ", "is a test."])
    embed_and_upsert(chunks, store, provider, prefix=F.lit("vector-"))
    calls = [json.loads(line) for line in open(log)]
    assert sorted(calls) == [["hello ", "world! This "], ["is a test."]]
    rows = [json.loads(line) for line in open(f"{log}.rows")]
    assert all(len(batch) <= 2 for batch in rows)
    sent = sorted((r["id"], r["vector"]) for batch in rows for r in batch)
    assert sent == [("vector-:0-6", [1.0]), ("vector-:18-28", [1.0]), ("vector-:6-18", [1.0])]
    embed_and_upsert(chunk_frame(spark, ["x"]).limit(0), store, provider)
    assert len(open(f"{log}.rows").readlines()) == len(rows)


def test_provider_failures(spark):
    def short():
        return lambda texts: [[1.0]]

    chunks = chunk_frame(spark, ["a", "b"])
    once = Retry(1, 0, 0)
    with pytest.raises(Exception, match="2 texts gave 1 vectors"):
        embed_chunks(chunks, client_provider("short", 1, short, retry=once)).collect()
    with pytest.raises(ValueError):
        client_provider("big", 1, short, batch_limit=10, batch_size=11)
    with pytest.raises(ValueError):
        get_provider("unheard of")
    assert in_input_order([(1, "b"), (0, "a")], 2) == ["a", "b"]
    register_provider("short", lambda: client_provider("short", 1, short))
    assert get_provider("short").dimension == 1


def test_retry():
    waits, tries = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    assert Retry(3, 1, 20).call(flaky, waits.append) == "done"
    assert len(waits) == 2 and all(1 <= w <= 20 for w in waits)
    with pytest.raises(ZeroDivisionError):
        Retry(2, 0, 0).call(lambda: 1 / 0, waits.append)


def test_term_vectors(spark):
    df = chunk_frame(spark, ["a b a", "", "ü 1"])
    vectors = [r.vector for r in embed_chunks(df, get_provider("term-hash-1536")).orderBy("seq").collect()]
    assert [len(v) for v in vectors] == [1536] * 3
    assert [sorted(x for x in v if x) for v in vectors] == [[1.0, 2.0], [], [1.0, 1.0]]


META = T.StructType(
    [T.StructField("foo", T.StringType()), T.StructField("bar", T.IntegerType()), T.StructField("quuz", T.DoubleType())]
)


def stored(spark, rows, width=1536):
    data = [(i, [float(v)] * width, (f"foo-{v}", v, float(v))) for i, v in rows]
    return spark.createDataFrame(
        data, "id string, vector array<float>, metadata struct<foo:string,bar:int,quuz:double>"
    )


def contents(df):
    return {r.id: (r.vector[0], len(r.vector), tuple(r.metadata)) for r in df.collect()}


def new_path(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def test_store_round_trip(spark):
    path = new_path(spark)
    store = vs.get_store("parquet", spark, path, 1536, META, buckets=4)
    assert store.count() == 0
    store.upsert(stored(spark, [("1", 1), ("2", 2), ("3", 3)]))
    assert store.count() == 3
    ids = spark.createDataFrame([("1",), ("3",), ("9",)], "id string")
    assert contents(store.fetch(ids)) == {
        str(v): (float(v), 1536, (f"foo-{v}", v, float(v))) for v in (1, 3)
    }
    store.upsert(stored(spark, [("2", 20), ("4", 4)]))
    again = vs.ParquetVectorStore(spark, path, 1536, META, buckets=4)
    assert {k: v[0] for k, v in contents(again.read()).items()} == {"1": 1, "2": 20, "3": 3, "4": 4}
    assert vs.count(again.read()).first().vectors == 4
    with pytest.raises(ValueError, match="was created with"):
        vs.ParquetVectorStore(spark, path, 64, META, buckets=4)


def test_failed_upsert_leaves_the_collection(spark):
    store = vs.ParquetVectorStore(spark, new_path(spark), 8, META, buckets=4)
    store.upsert(stored(spark, [(str(i), i) for i in range(20)], 8))
    with pytest.raises(Exception, match="8 dimensions"):
        store.upsert(stored(spark, [("1", 7)], 9))
    assert contents(store.read())["1"][0] == 1 and store.count() == 20
    store.upsert(stored(spark, [("1", 7)], 8))
    assert contents(store.read())["1"][0] == 7 and store.count() == 20


@pytest.mark.parametrize("begun", [False, True])
def test_upserts_at_once_all_survive(spark, begun):
    path = new_path(spark)
    stores = [vs.ParquetVectorStore(spark, path, 8, META, buckets=2) for _ in range(2)]
    if begun:
        stores[0].upsert(stored(spark, [("0", 0)], 8))
    slow, fast = stores
    publish = slow._publish

    def late(*args):
        # The other writer publishes between this one's reading and its publishing.
        slow._publish = publish
        fast.upsert(stored(spark, [("b", 2), ("c", 3)], 8))
        return publish(*args)

    slow._publish = late
    slow.upsert(stored(spark, [("a", 1), ("c", 4)], 8))
    kept = {k: v[0] for k, v in contents(slow.read()).items()}
    assert kept == {"a": 1, "b": 2, "c": 4} | ({"0": 0} if begun else {})
    assert not slow._children("staged")


def test_duplicates_in_a_batch(spark):
    batch = stored(spark, [("1", 5), ("1", 9), ("1", 7)], 8).withColumn("at", 10 - F.col("metadata.bar"))
    store = vs.ParquetVectorStore(spark, new_path(spark), 8, META)
    store.upsert(batch, version=F.col("at"))
    assert contents(store.read())["1"][0] == 5
    store.upsert(batch)
    assert contents(store.read())["1"][0] == 9


def test_store_checks(spark):
    with pytest.raises(ValueError, match="lacks the fields"):
        vs.ParquetVectorStore(spark, new_path(spark), 8, META, required_metadata=frozenset({"url"}))
    with pytest.raises(ValueError):
        vs.get_store("unheard of")
    plain = spark.createDataFrame([("1", [1.0])], "id string, vector array<float>")
    with pytest.raises(ValueError, match="metadata"):
        vs.payload(plain, 1, META)
    assert vs.payload(plain, 1).columns == ["id", "vector"]
    vs.register_store("plain", lambda *a: "built")
    assert vs.get_store("plain") == "built"


def small_options(bucket="up"):
    return IngestOptions(bucket=bucket, part_size=500, chunk_size=90, min_tokens=5, max_tokens=30)


def expected_ids(folder, options):
    return {
        f"{options.bucket}/{f.name}:{s}-{e}"
        for f in folder.iterdir()
        for _, _, _, s, e in by_hand(f.read_bytes(), options)
    }


def test_ingest_files(spark, folder):
    options = small_options()
    store = ingest_files(spark, str(folder), new_path(spark), options)
    assert {r.id for r in store.read().collect()} == expected_ids(folder, options)


def test_stream_of_files(spark, folder):
    options, provider = small_options(), get_provider("term-hash-64")
    store = vs.ParquetVectorStore(spark, new_path(spark), 64)
    checkpoint = new_path(spark)

    def run():
        source = arriving_objects(spark, str(folder), options.bucket)
        start_ingest(source, lambda b: parts_of_arriving(b, options), store, provider, checkpoint, options).awaitTermination()
        return {r.id for r in store.read().collect()}

    assert run() == expected_ids(folder, options)
    (folder / "late.txt").write_text("Something new. " * 20)
    assert run() == expected_ids(folder, options)


def test_stream_of_notifications(spark, folder, tmp_path):
    options, provider = small_options(), get_provider("term-hash-64")
    (tmp_path / "queue").mkdir()
    lines = [message("a.txt"), json.dumps({"Event": "s3:TestEvent"}), message("a.txt"), message("b.txt")]
    (tmp_path / "queue" / "1.json").write_text("\n".join(lines))
    store = vs.ParquetVectorStore(spark, new_path(spark), 64)
    source = arriving_notifications(spark, str(tmp_path / "queue"))
    start_ingest(
        source, lambda b: parts_of_notified(b, str(folder), options), store, provider, new_path(spark), options
    ).awaitTermination()
    assert {r.id for r in store.read().collect()} == expected_ids(folder, options)
    missing = spark.createDataFrame([("up/none", "none")], "object_id string, key string")
    with pytest.raises(Exception, match="none"):
        stat_objects(missing, str(folder)).collect()


def test_a_missing_object_does_not_stop_a_stream(spark, folder, tmp_path):
    lost = new_path(spark)
    options, provider = replace(small_options(), dead_letter_path=lost), get_provider("term-hash-64")
    (tmp_path / "queue").mkdir()
    (tmp_path / "queue" / "1.json").write_text("\n".join([message("a.txt"), message("gone.txt"), message("b.txt")]))
    store = vs.ParquetVectorStore(spark, new_path(spark), 64)
    source = arriving_notifications(spark, str(tmp_path / "queue"))
    start_ingest(
        source, lambda b: parts_of_notified(b, str(folder), options), store, provider, new_path(spark), options
    ).awaitTermination()
    assert {r.id for r in store.read().collect()} == expected_ids(folder, options)
    assert [r.object_id for r in spark.read.parquet(lost).collect()] == ["up/gone.txt"]


def test_options(monkeypatch):
    monkeypatch.setenv("EMBEDDING_MODEL_NAME", "from-env")
    monkeypatch.setenv("PART_SIZE", "123")
    assert IngestOptions().embedding_model == "from-env"
    assert IngestOptions().part_size == 123
    assert IngestOptions(embedding_model="given").embedding_model == "given"
    for bad in ({"part_size": 0}, {"chunk_size": 0}, {"on_invalid": "ignore"}):
        with pytest.raises(ValueError):
            IngestOptions(**bad)


def test_no_shuffle_before_the_store(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    chunks = prepare_parts(parts_of_table(objects_from_table(docs, "d", F.col("doc_id"), F.col("text")), IngestOptions()))
    vectors = assemble_vectors(embed_chunks(chunks, get_provider("term-hash-64")))
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan




def test_parts_of_huge_objects_are_planned_in_two_steps(spark):
    from textmill.sources.objects import _PARTS_AT_ONCE

    sizes = [("a", 1), ("b", 1000 * _PARTS_AT_ONCE), ("c", 1000 * _PARTS_AT_ONCE + 1), ("d", 3 * 10**9 + 7), ("e", 0)]
    objects = spark.createDataFrame(sizes, "object_id string, length bigint")
    found = plan_parts(objects, 1000).groupBy("object_id").agg(
        F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes"), F.countDistinct("start").alias("starts"), F.max("end").alias("end")
    )
    expected = {(k, -(-n // 1000), n, -(-n // 1000), n) for k, n in sizes if n}
    assert {tuple(r) for r in found.collect()} == expected


def test_neighbouring_parts_are_read_together():
    from textmill.sources.objects import _BATCH_BYTES, _neighbours

    row = lambda o, s, e: {"object_id": o, "path": o, "start": s, "end": e}
    rows = [row("a", 0, 5), row("a", 5, 9), row("a", 10, 12), row("b", 12, 13), row("b", 13, 14 + _BATCH_BYTES), row("b", 14 + _BATCH_BYTES, 20 + _BATCH_BYTES)]
    assert [[(r["object_id"], r["start"]) for r in run] for run in _neighbours(rows)] == [
        [("a", 0), ("a", 5)], [("a", 10)], [("b", 12)], [("b", 13)], [("b", 14 + _BATCH_BYTES)]
    ]
