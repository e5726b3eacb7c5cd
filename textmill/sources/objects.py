"""Objects, their byte-range parts, and the chunks of a part."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.digests import BLOCK, START, md5_blocks, md5_end
from textmill.functions.utf8 import byte_range

# Default size of a part and of a chunk inside a part.
PART_SIZE = 1_048_576
CHUNK_SIZE = 1_048_576

# Bytes of a part that one task holds are bounded by the part size.
_MAX_PART_SIZE = 256 * 1024 * 1024
# Fixed value: characters that make a path a pattern.
_WILDCARD = re.compile(r"[*?\[{\\]")
# Bytes of parts that a reading task sends on in one batch, and reads in one go by default.
_BATCH_BYTES = 16 * 1024 * 1024
#: Parts of an object that one row lists while parts are planned.
_PARTS_AT_ONCE = 4096
_TASK_BYTES = 256 * 1024 * 1024


def check_sizes(part_size: int, chunk_size: int) -> None:
    if not 1 <= part_size <= _MAX_PART_SIZE:
        raise ValueError(f"part_size must lie in [1, {_MAX_PART_SIZE}]")
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")


def _object_id(spark: SparkSession, root: str, bucket: str | None) -> Column:
    """``bucket/key`` with the path below the root as key, or the path itself.

    Of a pattern the root is the part before its first wildcard, so two files never share an id.
    """
    if bucket is None:
        return F.col("path")
    wildcard = _WILDCARD.search(root)
    if wildcard:
        root = root[: root.rfind("/", 0, wildcard.start()) + 1] or "."
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = system.makeQualified(folder).toString().rstrip("/") + "/"
    below = F.substring("path", len(prefix) + 1, 1 << 30)
    # A root that names one file has no path below it.
    key = F.when(F.startswith("path", F.lit(prefix)), below).otherwise(F.substring_index("path", "/", -1))
    return F.concat(F.lit(f"{bucket}/"), key)


def list_objects(spark: SparkSession, path: str, bucket: str | None = None, **options: str) -> DataFrame:
    """Files as objects, metadata only: ``(object_id, path, length)``.

    The content column is never selected, so no file is opened.  With ``bucket`` the id
    is ``bucket/key`` and the key is the path below the folder; otherwise it is the path.
    """
    files = spark.read.format("binaryFile").options(**options).load(path)
    return object_metadata(files, path, bucket)


def object_metadata(files: DataFrame, root: str, bucket: str | None = None) -> DataFrame:
    """Object id and size of rows of the binary file source (batch or stream)."""
    object_id = _object_id(files.sparkSession, root, bucket)
    return files.select(object_id.alias("object_id"), "path", "length")


def read_objects(spark: SparkSession, path: str, bucket: str | None = None, **options: str) -> DataFrame:
    """Files as objects with their whole body: ``(object_id, length, content)``."""
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.select(_object_id(spark, path, bucket).alias("object_id"), "length", "content")


def digest_objects(objects: DataFrame, listed: DataFrame, stretch: int = _TASK_BYTES) -> DataFrame:
    """MD5 of whole files ``(object_id, length, digest)``, of which no task reads more than ``stretch`` bytes.

    ``objects`` are the files as ``read_objects`` gives them and ``listed`` as ``list_objects`` does.
    A file of up to ``stretch`` bytes is read as one row.  A larger one is read by seeking, a stretch
    in a round: MD5 is a chain over the bytes, so the task of a stretch starts from the 16 bytes that
    the one before has left.  Files go side by side, and the driver keeps a row per larger file.
    Rounds run while the plan is built.  In a store that only Spark opens, every file is one row.
    """
    if stretch < BLOCK or stretch % BLOCK:
        raise ValueError(f"stretch must be a multiple of {BLOCK}")
    spark = objects.sparkSession
    larger = listed.filter(F.col("length") > stretch).select("object_id", "path", "length").collect()
    waiting = [(tuple(r), START, None) for r in larger] if larger and _can_seek(larger[0]["path"]) else []
    # The filter reaches the file source, which does not open the larger files.
    rows = objects.filter(F.col("length") <= stretch) if waiting else objects
    whole = rows.select("object_id", "length", F.md5("content").alias("digest"))
    found: list[tuple[str, int, str]] = []
    start = 0
    while waiting:
        # One file per task, so that two stretches never meet in one.
        read = [
            (file, *rest)
            for file, *rest in spark.sparkContext.parallelize(waiting, len(waiting))
            .map(lambda row, start=start: _digest_stretch(*row, start, stretch))
            .collect()
        ]
        start += stretch
        found += [(file[0], file[2], value) for file, value, _ in read if start >= file[2]]
        waiting = [row for row in read if start < row[0][2]]
    if not found:
        return whole
    return whole.unionByName(spark.createDataFrame(found, "object_id string, length bigint, digest string"))


def _can_seek(path: str) -> bool:
    try:
        store, name = _open_store(path)
        return store.get_file_info(name).is_file
    except (OSError, pa.ArrowException):
        return False


def _digest_stretch(file: tuple, value: bytes, stamp: tuple | None, start: int, stretch: int) -> tuple:
    """The file, its chaining value after a stretch or, after the last one, its digest, and its time stamp."""
    _, path, length = file
    store, name = _open_store(path)
    info = store.get_file_info(name)
    now = (info.size, info.mtime_ns)
    if info.size != length or now != (stamp or now):
        raise OSError(f"{path} changed while it was read")
    end = min(start + stretch, length)
    with store.open_input_file(name) as handle:
        for at in range(start, end, _BATCH_BYTES):
            size = min(_BATCH_BYTES, end - at)
            data = handle.read_at(size, at)
            if len(data) != size:
                raise OSError(f"{path} changed while it was read")
            # Only the end of a file is no whole number of blocks.
            blocks = size - size % BLOCK
            value, rest = md5_blocks(value, data[:blocks]), data[blocks:]
    return file, md5_end(value, rest, length) if end == length else value, now


def objects_from_table(df: DataFrame, bucket: str, key: Column, text: Column) -> DataFrame:
    """Rows of a text table as objects: ``(object_id, length, content)``.

    A null text is an empty object: it is listed and has no parts.  A null key fails the job.
    """
    content = F.coalesce(text.cast("binary"), F.lit(b""))
    missing = F.raise_error(F.lit("a row without a key is no object")).cast("string")
    key = F.coalesce(key.cast("string"), missing)
    return df.select(
        F.concat(F.lit(f"{bucket}/"), key).alias("object_id"),
        F.octet_length(content).cast("bigint").alias("length"),
        content.alias("content"),
    )


def plan_parts(objects: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Byte ranges ``[start, end)`` of every object, keeping its other columns.

    An empty object has no parts.  Objects are cut in two steps, so that no row holds more than
    some thousand starts however large an object is.
    """
    check_sizes(part_size, 1)
    size, stretch = (F.lit(n).cast("bigint") for n in (part_size, part_size * _PARTS_AT_ONCE))
    last = F.least(F.col("__stretch") + stretch, F.col("length")) - 1
    return (
        objects.filter(F.col("length") > 0)
        .withColumn("__stretch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, stretch)))
        .withColumn("start", F.explode(F.sequence(F.col("__stretch"), last, size)))
        .withColumn("end", F.least(F.col("start") + size, F.col("length")))
        .drop("__stretch")
    )


def cut_parts(objects: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Parts with their bytes ``(object_id, start, end, data)`` of objects held in rows."""
    parts = plan_parts(objects.select("object_id", "length", "content"), part_size)
    return parts.select(
        "object_id",
        "start",
        "end",
        byte_range(F.col("content"), F.col("start"), F.col("end") - F.col("start")).alias("data"),
    )


def _open_store(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme) :]
    return fs.FileSystem.from_uri(path)


def stat_objects(keys: DataFrame, root: str, on_missing: str = "fail") -> DataFrame:
    """Sizes of named objects ``(object_id, key)`` below ``root``: adds ``path, length``.

    One metadata request per object and none for its bytes.  A missing object fails the
    job, so that its message is delivered again; with ``on_missing="null"`` its length is null.
    """
    if on_missing not in ("fail", "null"):
        raise ValueError("on_missing must be 'fail' or 'null'")
    prefix = root.rstrip("/")
    schema = pa.schema([("object_id", pa.string()), ("path", pa.string()), ("length", pa.int64())])

    def stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                path = f"{prefix}/{row['key']}"
                store, name = _open_store(path)
                info = store.get_file_info(name)
                if not info.is_file and on_missing == "fail":
                    raise FileNotFoundError(path)
                rows.append({"object_id": row["object_id"], "path": path, "length": info.size if info.is_file else None})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return keys.select("object_id", "key").mapInArrow(stat, "object_id string, path string, length bigint")


def read_ranges(parts: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Read planned parts ``(object_id, path, start, end)`` by seeking; adds ``data``.

    The planned rows are what gets shuffled, not the bytes: stretches of neighbouring parts go to
    one task, which opens a file once and reads neighbours in one go, and a file of any size
    spreads over all tasks.  The number of tasks is explicit because descriptors are tiny and
    would be merged by size otherwise.
    """
    spark = parts.sparkSession
    columns = ["object_id", "path", "start", "end"]
    # One pass over listing metadata; it opens no file.
    total = parts.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    if num_partitions is None:
        num_partitions = max(spark.sparkContext.defaultParallelism, -(-total // _TASK_BYTES))
    stretch = F.lit(max(1, total // num_partitions)).cast("bigint")
    schema = pa.schema(
        [("object_id", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("data", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, handle = None, None
        try:
            for run in _neighbours(row for batch in batches for row in batch.to_pylist()):
                if run[0]["path"] != opened:
                    if handle is not None:
                        handle.close()
                    store, name = _open_store(run[0]["path"])
                    opened, handle = run[0]["path"], store.open_input_file(name)
                begin, size = run[0]["start"], run[-1]["end"] - run[0]["start"]
                data = handle.read_at(size, begin)
                if len(data) != size:
                    raise OSError(f"{opened} changed while it was read")
                cut = [{**row, "data": data[row["start"] - begin : row["end"] - begin]} for row in run]
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in schema.names} for row in cut], schema=schema)
        finally:
            if handle is not None:
                handle.close()

    near = F.call_function("div", F.col("start"), stretch)
    return (
        parts.select(*columns)
        .repartition(num_partitions, "path", near)
        .sortWithinPartitions("path", "start")
        .mapInArrow(read, "object_id string, start bigint, end bigint, data binary")
    )


def _neighbours(rows: Iterable[dict]) -> Iterator[list[dict]]:
    """Runs of parts that continue each other, of a few megabytes at most or one part."""
    run: list[dict] = []
    for row in rows:
        follows = run and (row["object_id"], row["path"], row["start"]) == (run[0]["object_id"], run[0]["path"], run[-1]["end"])
        if run and not (follows and row["end"] - run[0]["start"] <= _BATCH_BYTES):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def chunk_array(chunk_size: int = CHUNK_SIZE, data: str = "data", start: str = "start") -> Column:
    """The chunks of a part as an ordered array of ``(data, start, end)``."""
    check_sizes(1, chunk_size)
    size, step = F.octet_length(data), F.lit(chunk_size)
    count = F.ceil(size / step).cast("int")
    chunk = lambda i: F.struct(
        byte_range(F.col(data), i * step, step).alias("data"),
        (F.col(start) + i * step).cast("bigint").alias("start"),
        (F.col(start) + F.least((i + 1) * step, size)).cast("bigint").alias("end"),
    )
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), chunk)).otherwise(F.array())


def chunk_parts(parts: DataFrame, chunk_size: int = CHUNK_SIZE, encoding: str = "utf-8") -> DataFrame:
    """The chunks of parts as a chunk stream ``(object_id, part_start, seq, data, …)``."""
    check_sizes(1, chunk_size)
    step = F.lit(chunk_size).cast("bigint")
    length = F.col("end") - F.col("start")
    seq = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((length - 1) / step).cast("bigint")))
    low = F.col("seq") * step
    return (
        parts.filter(length > 0)
        .select("object_id", F.col("start").alias("part_start"), seq.alias("seq"), "data", length.alias("__size"))
        .select(
            "object_id",
            "part_start",
            "seq",
            byte_range(F.col("data"), low, step).alias("data"),
            (F.col("part_start") + low).alias("start"),
            (F.col("part_start") + F.least(low + step, F.col("__size"))).alias("end"),
            F.lit(encoding).alias("encoding"),
        )
    )
