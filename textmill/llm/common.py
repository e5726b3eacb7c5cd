"""What the operators of this subpackage share: tables, staging, words, block rows."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import shared_folder

#: A word is a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters as bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later jobs then start from files that outlive any executor.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/textmill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the folders that ``staged`` wrote for ``df``; call it when the results are written."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/textmill-" in f}:
        folder = hadoop(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def give_back() -> None:
    """Return freed memory to the system: workers of many queries share a machine and live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def text_slices(batches, text_col: str, size: int = 4 << 20):
    """Arrow batches again, cut so that a slice holds about ``size`` bytes of text or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text_col))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch, lengths
        give_back()


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts, the place of each word in them, and where texts start.

    Cuts at the six ASCII white space characters; may give empty words.  Null is empty.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words = lists.flatten().dictionary_encode()
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=starts[1:])
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts


class WordCache:
    """Rows of numbers for words, computed once each; emptied when it has ``most`` words."""

    def __init__(self, compute, most: int = 250_000):
        self.compute, self.most = compute, most
        self.places: dict[str, int] = {}
        self.parts: list = []

    def rows_of(self, words: pa.Array) -> np.ndarray:
        """Where the given words' values are in ``values``."""
        names = words.to_pylist()
        found = [self.places.get(w, -1) for w in names]
        new = found.count(-1)
        if len(self.places) + new > self.most and self.places:
            self.places, self.parts = {}, []
            found, new = [-1] * len(names), len(names)
        if new:
            at = len(self.places)
            missing = [w for w, place in zip(names, found, strict=True) if place < 0]
            self.places.update(zip(missing, range(at, at + new), strict=True))
            # In portions, because a word takes far more memory on the way than in the end.
            self.parts += [self.compute(missing[a : a + 20_000]) for a in range(0, new, 20_000)]
            found = np.array(found, np.int64)
            found[found < 0] = np.arange(at, at + new)
        return np.asarray(found, np.int64)
