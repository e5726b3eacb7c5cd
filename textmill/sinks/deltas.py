"""What a log-structured collection consists of, and how its layers become one.

An upsert adds a delta, a file or so per hash bucket; nothing is read or rewritten for it.  The
published state lists the deltas of every bucket in their order.  Readers let the latest delta of
an id win.  Compaction merges the newest deltas of a bucket once enough of about their size have
come together, so that a row is rewritten a number of times that grows with the logarithm of the
collection over the batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How ids of one object begin: everything before the byte range.
PREFIX = r"^(.*):\d+-\d+$"
#: A larger neighbour is merged too if it has no more than this many times the rows.
GROWTH = 2


class Delta(NamedTuple):
    """Rows of one bucket that were published together; ``version`` names their folder."""

    bucket: int
    sequence: int
    version: int
    rows: int


class Replaced(NamedTuple):
    """Objects whose earlier rows no longer count; ``version`` names the folder of their prefixes."""

    sequence: int
    version: int


class State(NamedTuple):
    """A published state: what readers of a collection see."""

    number: int = 0
    deltas: tuple[Delta, ...] = ()
    replaced: tuple[Replaced, ...] = ()

    def by_bucket(self) -> dict[int, list[Delta]]:
        found: dict[int, list[Delta]] = defaultdict(list)
        for delta in sorted(self.deltas, key=lambda d: (d.bucket, d.sequence)):
            found[delta.bucket].append(delta)
        return dict(found)

    def with_batch(self, version: int, rows: dict[int, int], replaces: bool) -> State:
        """The next state: a batch on top, wherever it has rows."""
        number = self.number + 1
        more = tuple(Delta(bucket, number, version, n) for bucket, n in sorted(rows.items()))
        gone = (Replaced(number, version),) if replaces else ()
        return State(number, self.deltas + more, self.replaced + gone)._trimmed()

    def with_merged(self, merged: Iterable[list[Delta]], sequence: int, version: int, rows: dict[int, int]) -> State | None:
        """The next state with deltas merged up to ``sequence`` in place of their parts.

        Buckets whose parts another compaction has replaced meanwhile stay as they are; None if
        that goes for all.
        """
        live = set(self.deltas)
        mine = [parts for parts in merged if live.issuperset(parts)]
        if not mine:
            return None
        left = live.difference(d for parts in mine for d in parts)
        left |= {Delta(b, sequence, version, rows[b]) for parts in mine if (b := parts[0].bucket) in rows}
        return State(self.number + 1, tuple(sorted(left)), self.replaced)._trimmed()

    def _trimmed(self) -> State:
        """Without replacements that no delta is older than."""
        oldest = min((d.sequence for d in self.deltas), default=self.number + 1)
        return self._replace(replaced=tuple(r for r in self.replaced if r.sequence > oldest))


def due(deltas: list[Delta], fan: int) -> list[Delta]:
    """The newest deltas of a bucket that are to be merged now; none if they are too few."""
    first, total = len(deltas) - 1, deltas[-1].rows
    while first and deltas[first - 1].rows <= GROWTH * total:
        first -= 1
        total += deltas[first].rows
    return deltas[first:] if len(deltas) - first >= fan else []


def without_replaced(rows: DataFrame, replaced: DataFrame) -> DataFrame:
    """``rows (id, sequence, ...)`` but those older than the last replacement of their object.

    ``replaced (prefix, sequence)`` may name an object several times.
    """
    last = replaced.groupBy("prefix").agg(F.max("sequence").alias("__since"))
    found = rows.withColumn("prefix", F.regexp_extract("id", PREFIX, 1)).join(last, "prefix", "left").drop("prefix")
    return found.filter(F.col("__since").isNull() | (F.col("sequence") >= F.col("__since"))).drop("__since")


def newest_per_id(rows: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """``rows (id, sequence, ...)`` of the highest sequence of each id; a pair of them occurs once.

    With ``replaced``, those of objects replaced since are left out.  Only ids and sequences are
    grouped and compared; the vectors meet no more than the list of winners.
    """
    winners = rows.groupBy("id").agg(F.max("sequence").alias("sequence"))
    if replaced is not None:
        # Where the newest row of an id is too old, the others are too.
        winners = without_replaced(winners, replaced)
    return rows.join(winners, ["id", "sequence"], "left_semi")
