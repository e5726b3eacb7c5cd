"""Vector collections: upsert by id, fetch, count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from copy import copy
from functools import reduce
from typing import Protocol

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.retry import COLLECTION_RETRY, UPSERT_RETRY, Retry
from textmill.schema import NO_METADATA, VECTOR, stored_vector
from textmill.sinks.deltas import Delta, Replaced, State, due, newest_per_id, without_replaced

# Fixed value: vectors per call that a vector service accepts.
UPSERT_BATCH_LIMIT = 100
#: Tries of one upsert to publish before it gives up against other writers.
PUBLISH_ATTEMPTS = 20

#: Ids that a fetch looks up by value; more are joined.
LOOKUP = 1_000

_BUCKET = "bucket"
_VERSION = "version"
_MAX_BUCKETS = 16_384
_STATE = "bucket int, sequence bigint, version bigint, rows bigint"


def _new_version() -> int:
    return uuid.uuid4().int >> 66


class VectorStore(Protocol):
    """What the ingest job needs from a store."""

    def upsert(
        self, vectors: DataFrame, version: Column | None = None, unique: bool = False, replaced: DataFrame | None = None
    ) -> None: ...


def check_metadata(metadata: T.StructType, required: frozenset[str] = frozenset()) -> None:
    """The metadata type must hold the required fields."""
    missing = required - set(metadata.fieldNames())
    if missing:
        raise ValueError(f"metadata lacks the fields {sorted(missing)}")


def check_dimension(vector: Column, dimension: int) -> Column:
    """The vector itself; a vector of another width (or none) fails the job."""
    return F.when(F.size(vector) == dimension, vector).otherwise(
        F.raise_error(F.lit(f"vectors must have {dimension} dimensions")).cast(VECTOR)
    )


def payload(
    vectors: DataFrame, dimension: int, metadata: T.StructType = NO_METADATA, carried: tuple[Column, ...] = ()
) -> DataFrame:
    """The columns a collection stores, checked; ``carried`` columns are kept beside them."""
    columns = [F.col("id").cast("string").alias("id")]
    columns.append(check_dimension(F.col("vector").cast(VECTOR), dimension).alias("vector"))
    if metadata.fields:
        if "metadata" not in vectors.columns:
            raise ValueError("vectors lack the metadata column")
        given = vectors.schema["metadata"].dataType.fieldNames()
        check_metadata(T.StructType([T.StructField(n, T.NullType()) for n in given]), frozenset(metadata.fieldNames()))
        fields = [F.col(f"metadata.{f.name}").cast(f.dataType).alias(f.name) for f in metadata.fields]
        columns.append(F.struct(*fields).alias("metadata"))
    return vectors.select(*columns, *carried)


def latest_per_id(vectors: DataFrame, version: str | None = None) -> DataFrame:
    """One row per id: the highest version, ties broken by the values themselves.

    An aggregate rather than a window: copies of one id are reduced before the shuffle,
    however many there are.
    """
    values = [c for c in vectors.columns if c not in ("id", version)]
    ordered = [version, *values] if version else values
    latest = vectors.groupBy("id").agg(F.max(F.struct(*ordered)).alias("row"))
    return latest.select("id", *[f"row.{c}" for c in values])


def latest_payload(
    vectors: DataFrame,
    dimension: int,
    metadata: T.StructType = NO_METADATA,
    version: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """The checked columns of a batch, each id once; ``unique`` says that this holds already."""
    if unique:
        return payload(vectors, dimension, metadata)
    if version is None:
        return latest_per_id(payload(vectors, dimension, metadata))
    return latest_per_id(payload(vectors, dimension, metadata, (version.alias("__version"),)), "__version")


def merge_vectors(current: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or replace by id; ``new`` holds each id once."""
    return current.join(new.select("id"), "id", "left_anti").unionByName(new)


def fetch(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """The stored vectors whose id is in ``ids``."""
    return vectors.join(ids.select("id"), "id", "left_semi")


def count(vectors: DataFrame) -> DataFrame:
    """The number of vectors, as a one-row table."""
    return vectors.agg(F.count(F.lit(1)).alias("vectors"))


class ParquetVectorStore:
    """A collection as Parquet files: deltas by hash bucket of the id, latest wins.

    An upsert appends its rows under a version of its own and then publishes a state that lists
    them, so the bytes it writes follow the batch.  Readers see one published state or the next,
    and an attempt that failed half-way leaves nothing they look at.  A state is published by a
    rename that fails if another writer was first; the upsert then publishes on top of what that
    writer did, without writing its rows again.  Buckets that have gathered enough deltas are
    compacted after an upsert, ``compact`` does so at any time, and ``vacuum`` deletes what no
    recent state names.

    This needs a file system whose rename does not replace a folder; where a table format with
    MERGE is at hand, prefer it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        dimension: int,
        metadata: T.StructType = NO_METADATA,
        buckets: int = 64,
        required_metadata: frozenset[str] = frozenset(),
        fan: int = 4,
    ):
        if dimension < 1:
            raise ValueError("dimension must be at least 1")
        if not 1 <= buckets <= _MAX_BUCKETS:
            raise ValueError(f"buckets must lie in [1, {_MAX_BUCKETS}]")
        if fan < 2:
            raise ValueError("fan must be at least 2")
        check_metadata(metadata, required_metadata)
        self.spark, self.path = spark, path.rstrip("/")
        self.dimension, self.metadata, self.buckets, self.fan = dimension, metadata, buckets, fan
        self._create_or_check()

    @property
    def schema(self) -> T.StructType:
        return stored_vector(self.metadata)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int")

    def _system(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _children(self, name: str) -> list[str]:
        system, folder = self._system(), self._at(name)
        return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []

    def _exists(self, name: str) -> bool:
        return self._system().exists(self._at(name))

    def _drop(self, name: str) -> None:
        self._system().delete(self._at(name), True)

    def _move(self, name: str, target: str) -> bool:
        """Rename a folder; False, and the folder dropped, if the target is there already."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(self._at(target).toUri(), self.spark._jsc.hadoopConfiguration())
        self._system().mkdirs(self._at(target).getParent())
        plainly = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(self._at(name), self._at(target), plainly)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            self._drop(name)
            return False
        return True

    def _create_or_check(self) -> None:
        """Create the collection if nobody has; of two creators the first one's settings count."""
        wanted = {
            "dimension": self.dimension,
            "buckets": self.buckets,
            "metadata": json.loads(self.metadata.json()),
            "indexed": self.metadata.fieldNames(),
        }
        if not self._exists("collection/_SUCCESS"):
            ready = f"staged/{_new_version()}-collection"
            text = self.spark.range(1).select(F.lit(json.dumps(wanted)).alias("value"))
            text.coalesce(1).write.text(f"{self.path}/{ready}")
            self._move(ready, "collection")
        found = json.loads(self.spark.read.text(f"{self.path}/collection").first()[0])
        if found != wanted:
            raise ValueError(f"collection {self.path} was created with {found}")

    def _state(self, number: int) -> State:
        # One row per bucket and delta; compaction bounds the deltas of a bucket.
        rows = self.spark.read.schema(_STATE).parquet(f"{self.path}/published/{number}").collect()
        deltas = tuple(Delta(r.bucket, r.sequence, r.version, r.rows) for r in rows if r.bucket is not None)
        return State(number, deltas, tuple(Replaced(r.sequence, r.version) for r in rows if r.bucket is None))

    def _numbers(self) -> list[int]:
        """Published states, the latest first."""
        return sorted((int(name) for name in self._children("published") if name.isdigit()), reverse=True)

    def _published(self) -> State:
        """The last published state."""
        numbers = self._numbers()
        return self._state(numbers[0]) if numbers else State()

    def _publish(self, state: State) -> bool:
        """Publish a state under its number; False if that number has been published before."""
        ready = f"staged/{_new_version()}-state"
        rows = [tuple(d) for d in state.deltas] + [(None, r.sequence, r.version, None) for r in state.replaced]
        self.spark.createDataFrame(rows, _STATE).coalesce(1).write.parquet(f"{self.path}/{ready}")
        return self._move(ready, f"published/{state.number}")

    def _publish_next(self, following: Callable[[State], State | None]) -> State | None:
        """Publish what follows the last state, again and again until nobody else is first."""
        for _ in range(PUBLISH_ATTEMPTS):
            state = following(self._published())
            if state is None or self._publish(state):
                return state
        raise RuntimeError(f"other writers were first {PUBLISH_ATTEMPTS} times at {self.path}")

    def _write(self, rows: DataFrame, version: int, ids: int | None = None) -> dict[int, int]:
        """Write rows by bucket; the number of rows of each bucket that has some.

        With ``ids``, the most that a bucket may have, files get Bloom filters of that size.
        """
        folder = f"{self.path}/data/{_VERSION}={version}"
        bloom = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": str(ids)} if ids else {}
        try:
            rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET).write.options(**bloom).partitionBy(
                _BUCKET
            ).parquet(folder)
        except Exception:
            self._drop(f"data/{_VERSION}={version}")
            raise
        # Footers alone are read for this.
        return {r[_BUCKET]: r["count"] for r in self._written(version).groupBy(_BUCKET).count().collect()}

    def _written(self, version: int) -> DataFrame:
        """The rows of one version with their bucket."""
        placed = T.StructType([*self.schema, T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(placed).parquet(f"{self.path}/data/{_VERSION}={version}")

    def _write_once(self, rows: DataFrame) -> tuple[int, dict[int, int]]:
        """Write rows by bucket, each id once; their version and the number of rows of each bucket.

        Rows are written as they come, and only their ids are read back and grouped, by hash: vectors
        are sorted by id only if an id was written twice or two ids share a hash.
        """
        token = _new_version()
        counts = self._write(rows, token)
        if not counts:
            return token, counts
        written = self._written(token)
        if not written.groupBy(F.xxhash64("id")).count().filter("count > 1").isEmpty():
            again = _new_version()
            counts = self._write(latest_per_id(written.drop(_BUCKET)), again)
            self._drop(f"data/{_VERSION}={token}")
            token = again
        return token, counts

    def _rows(self, deltas: Sequence[Delta]) -> DataFrame:
        """The rows of some deltas with their sequence."""
        sequences = {d.version: d.sequence for d in deltas}
        folders = [f"{self.path}/data/{_VERSION}={d.version}/{_BUCKET}={d.bucket}" for d in deltas]
        placed = T.StructType([*self.schema, T.StructField(_VERSION, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(placed).option("basePath", f"{self.path}/data").parquet(*folders)
        # One row per live version, as many as the state on the driver names.
        known = self.spark.createDataFrame(sorted(sequences.items()), f"{_VERSION} bigint, sequence bigint")
        return rows.drop(_BUCKET).join(F.broadcast(known), _VERSION).drop(_VERSION)

    def _replaced(self, state: State) -> DataFrame:
        folders = [f"{self.path}/replaced/{_VERSION}={r.version}" for r in state.replaced]
        found = self.spark.read.schema(f"prefix string, {_VERSION} bigint").option("basePath", f"{self.path}/replaced").parquet(*folders)
        known = self.spark.createDataFrame([(r.version, r.sequence) for r in state.replaced], f"{_VERSION} bigint, sequence bigint")
        return found.join(F.broadcast(known), _VERSION).select("prefix", "sequence")

    def _merged(self, state: State, groups: Iterable[list[Delta]], only: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """The rows of groups of deltas, one group per bucket, each id once."""
        alone, layered = [], []
        for deltas in groups:
            (alone if len(deltas) == 1 else layered).extend(deltas)
        found = []
        for deltas, layers in ((alone, False), (layered, True)):
            if deltas:
                rows, replaced = only(self._rows(deltas)), self._replaced(state) if state.replaced else None
                if layers:
                    rows = newest_per_id(rows, replaced)
                elif replaced is not None:
                    rows = without_replaced(rows, replaced)
                found.append(rows.select(*self.schema.fieldNames()))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The published vectors ``(id, vector[, metadata])``."""
        state = self._published()
        return self._merged(state, state.by_bucket().values())

    def upsert(
        self, vectors: DataFrame, version: Column | None = None, unique: bool = False, replaced: DataFrame | None = None
    ) -> None:
        """Insert or replace by id; the highest version of an id within the batch wins.

        ``replaced`` has a column ``prefix``: objects whose vectors are all in this batch, so that
        rows of theirs that were there before and are not in it are gone.  Of two upserts at once
        the one that publishes later wins where they share ids.
        """
        if version is None and not unique:
            token, rows = self._write_once(payload(vectors, self.dimension, self.metadata))
        else:
            token = _new_version()
            rows = self._write(latest_payload(vectors, self.dimension, self.metadata, version, unique), token)
        if replaced is not None:
            replaced.select(F.col("prefix").cast("string")).filter("prefix IS NOT NULL").distinct().write.parquet(
                f"{self.path}/replaced/{_VERSION}={token}"
            )
        if rows or replaced is not None:
            self._publish_next(lambda state: state.with_batch(token, rows, replaced is not None))
            self.compact()

    def compact(self, everything: bool = False) -> bool:
        """Merge the deltas that are due, or with ``everything`` all of them; False if there are none.

        Only the buckets concerned are read and written.
        """
        state = self._published()
        groups = [deltas if everything else due(deltas, self.fan) for deltas in state.by_bucket().values()]
        groups = [g for g in groups if len(g) > 1 or (everything and state.replaced)]
        if not groups:
            return False
        token = _new_version()
        rows = self._write(self._merged(state, groups), token, max(sum(d.rows for d in g) for g in groups))
        # Each group has the newest rows of its bucket, so they stand behind all that were published.
        if self._publish_next(lambda now: now.with_merged(groups, state.number, token, rows)) is None:
            self._drop(f"data/{_VERSION}={token}")
            return False
        return True

    def vacuum(self, keep: int = 1) -> None:
        """Delete the data of all but the last ``keep`` states.  No reader may be at an older one."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        numbers = self._numbers()
        live = {x.version for n in numbers[:keep] for x in (*self._state(n).deltas, *self._state(n).replaced)}
        # Versions that no state has named yet are being written.
        for number in numbers[keep:]:
            state = self._state(number)
            for version in {x.version for x in (*state.deltas, *state.replaced)} - live:
                self._drop(f"data/{_VERSION}={version}")
                self._drop(f"replaced/{_VERSION}={version}")
            self._drop(f"published/{number}")

    def fetch(self, ids: DataFrame) -> DataFrame:
        """The stored vectors whose id is in ``ids``; only their buckets are opened.

        Up to LOOKUP ids are looked up by value, so that compacted files whose Bloom filter lacks
        them are passed over.
        """
        wanted = ids.select(F.col("id").cast("string")).distinct()
        buckets = {r[0] for r in wanted.select(self._bucket()).distinct().collect()}
        few = [r.id for r in wanted.limit(LOOKUP + 1).collect()]
        state = self._published()
        groups = [deltas for bucket, deltas in state.by_bucket().items() if bucket in buckets]
        if len(few) <= LOOKUP:
            return self._merged(state, groups, lambda rows: rows.filter(F.col("id").isin(few)))
        return fetch(self._merged(state, groups), wanted)

    def count(self) -> int:
        """The number of vectors; without reading any where each bucket has one delta."""
        state = self._published()
        if not state.replaced and all(len(deltas) == 1 for deltas in state.by_bucket().values()):
            return sum(d.rows for d in state.deltas)
        return self.read().count()


class ClientVectorStore:
    """A store behind a service: workers connect once and send bounded batches.

    ``prepare`` runs once before the first batch, with patient retries: it creates the collection
    if the service lacks it.
    """

    def __init__(
        self,
        connect: Callable[[], Callable[[list[dict]], None]],
        dimension: int,
        metadata: T.StructType = NO_METADATA,
        batch_limit: int = UPSERT_BATCH_LIMIT,
        retry: Retry = UPSERT_RETRY,
        prepare: Callable[[int, list[str]], None] | None = None,
        prepare_retry: Retry = COLLECTION_RETRY,
    ):
        if not 1 <= batch_limit <= UPSERT_BATCH_LIMIT:
            raise ValueError(f"batch_limit must lie in [1, {UPSERT_BATCH_LIMIT}]")
        self.connect, self.dimension, self.metadata = connect, dimension, metadata
        self.batch_limit, self.retry = batch_limit, retry
        self.prepare, self.prepare_retry = prepare, prepare_retry
        self.prepared: list[bool] = []  # shared by copies

    def with_batches(self, size: int) -> ClientVectorStore:
        """The same store with batches of ``size`` vectors."""
        if not 1 <= size <= UPSERT_BATCH_LIMIT:
            raise ValueError(f"batch size must lie in [1, {UPSERT_BATCH_LIMIT}]")
        other = copy(self)
        other.batch_limit = size
        return other

    def upsert(
        self, vectors: DataFrame, version: Column | None = None, unique: bool = False, replaced: DataFrame | None = None
    ) -> None:
        """Send vectors in batches; services that only take upserts cannot drop what an object no longer has."""
        if replaced is not None:
            raise ValueError("a store behind a client cannot replace objects")
        if self.prepare and not self.prepared:
            prepare = self.prepare
            self.prepare_retry.call(lambda: prepare(self.dimension, self.metadata.fieldNames()))
            self.prepared.append(True)
        connect, limit, retry = self.connect, self.batch_limit, self.retry

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            client = connect()
            for batch in batches:
                for low in range(0, batch.num_rows, limit):
                    rows = batch.slice(low, limit).to_pylist()
                    retry.call(lambda rows=rows: client(rows))
                yield pa.RecordBatch.from_pydict({"sent": [batch.num_rows]})

        checked = latest_payload(vectors, self.dimension, self.metadata, version, unique)
        checked.mapInArrow(send, "sent bigint").agg(F.sum("sent")).collect()


_STORES: dict[str, Callable[..., VectorStore]] = {"parquet": ParquetVectorStore}


def register_store(name: str, build: Callable[..., VectorStore]) -> None:
    """Make a vector store available by name."""
    _STORES[name] = build


def get_store(name: str, *args, **options) -> VectorStore:
    """The vector store of a name, built with the given options."""
    if name not in _STORES:
        raise ValueError(f"no vector store is registered as {name!r}")
    return _STORES[name](*args, **options)
