"""Tables with one row per key, changed in atomic commits that rewrite only
the parts they touch.

    data/<run>/part=<part>/*.parquet   files, never changed once written
    commits/<version>.json             of each part: the runs that hold its rows;
                                       the last transaction of each writer; notes

A row's key determines its part (a time slice, a hash bucket), so a change reads
and writes the parts of its own rows and carries all others over by name. A
commit file is created by one writer only (sinks/claims.py): of two changes that
start from one version the second finds the name taken, and starts again from
the version now there. Files of a change that never commits are seen by nobody.

A commit lists all parts by name, about 50 bytes a run, so slices are chosen wide
enough for the history that a table keeps: ten years of hours are 88,000 parts.

A writer that repeats a transaction (a micro-batch replayed after a crash)
changes nothing: each commit names the last transaction id of its writer.

Defined results: rows without a key are not stored; null part values are the
part `none`; an empty table reads as no rows; repeated keys in one change count
as one row, by the table's `order` (the smallest; any of them where no order is
given, which is for keys that determine the row).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.sizing import broadcast_if_small
from tidewatch.sinks.claims import CommitConflict, claim, delete, names, read_text

NO_PART = "none"


def hour_of(column: str, hours: int = 1) -> Column:
    """Part of a row by the hour, or the slice of some hours, of a timestamp
    (slices since 1970, any session zone)."""
    return F.floor(F.unix_seconds(column) / (3600 * hours)).cast("string")


def bucket_of(column: str, buckets: int) -> Column:
    """Part of a row by a hash of its key."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class Head:
    """The state that a commit describes."""

    version: int = -1
    parts: dict[str, list[str]] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class KeyedTable:
    """`max_runs`: runs a part may consist of before they are folded into one;
    `tries`: how often a change starts again after losing a version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, part: Column,
                 order: list[str] | None = None, max_runs: int = 16, tries: int = 20):
        self.spark, self.path, self.schema, self.key, self.part = spark, path.rstrip("/"), schema, key, part
        self.order, self.max_runs, self.tries = order, max_runs, tries

    # ------------------------------------------------------------- reading

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, _ in names(self.spark, f"{self.path}/commits"))

    def head(self, version: int | None = None) -> Head:
        """The latest state, or that of a version."""
        if version is None:
            have = self.versions()
            if not have:
                return Head()
            version = have[-1]
        return Head(**json.loads(read_text(self.spark, self._commit_path(version))))

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def read(self, parts: Iterable[str] | None = None, head: Head | None = None) -> DataFrame:
        """The rows of the table, or of some parts; nothing else is opened."""
        head = head or self.head()
        chosen = head.parts if parts is None else [p for p in parts if p in head.parts]
        paths = [f"{self.path}/data/{run}/part={p}" for p in chosen for run in head.parts[p]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # ------------------------------------------------------------- writing

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """A new run holding `rows` by part, and its parts. Small partitions are
        put together and large ones split before they are written."""
        run = uuid.uuid4().hex
        placed = rows.select(*self.schema.names).withColumn("part", F.coalesce(self.part, F.lit(NO_PART)))
        placed.hint("rebalance", "part").write.partitionBy("part").parquet(f"{self.path}/data/{run}")
        return run, sorted(n.removeprefix("part=") for n, _ in names(self.spark, f"{self.path}/data/{run}") if n.startswith("part="))

    def _discard(self, run: str) -> None:
        delete(self.spark, f"{self.path}/data/{run}")

    def _commit(self, head: Head, parts: dict[str, list[str]], txn: tuple[str, int] | None, notes: dict[str, str] | None) -> Head:
        new = Head(head.version + 1, parts, {**head.writers, **({txn[0]: txn[1]} if txn else {})}, {**head.notes, **(notes or {})})
        if not claim(self.spark, self._commit_path(new.version), json.dumps(new.__dict__)):
            raise CommitConflict(f"version {new.version} of {self.path} already exists")
        return new

    def change(self, step: Callable[[Head], tuple[dict[str, list[str]], list[str], dict[str, str] | None] | None],
               txn: tuple[str, int] | None = None) -> Head:
        """Commit what `step(head)` makes: (all parts, runs written, notes), or
        None for no change. A lost version discards the runs and steps again."""
        for _ in range(self.tries):
            head = self.head()
            if txn and head.writers.get(txn[0], -1) >= txn[1]:
                return head
            made = step(head)
            if made is None:
                return head
            parts, runs, notes = made
            try:
                return self._commit(head, parts, txn, notes)
            except CommitConflict:
                for run in runs:
                    self._discard(run)
        raise CommitConflict(f"{self.path}: lost {self.tries} versions to other writers")

    def once(self, rows: DataFrame) -> DataFrame:
        """Each key of `rows` once."""
        keyed = rows.where(F.col(self.key).isNotNull()).select(*self.schema.names)
        if not self.order:
            return keyed.dropDuplicates([self.key])
        rest = [n for n in self.schema.names if n != self.key]
        best = keyed.groupBy(self.key).agg(F.min_by(F.struct(*rest), F.struct(*self.order)).alias("_r"))
        return best.select(*(F.col(n) if n == self.key else F.col(f"_r.`{n}`").alias(n) for n in self.schema.names))

    def insert_new(self, rows: DataFrame, txn: tuple[str, int] | None = None) -> Head:
        """Store the rows whose key the table does not hold; a stored row stays
        as it is. Of the table, only the keys of the rows' parts are read."""
        head = self.head()
        if txn and head.writers.get(txn[0], -1) >= txn[1]:
            return head
        staged, touched = self._write(self.once(rows))  # the input is read once
        if not touched:
            return self.change(lambda head: (head.parts, [], None), txn) if txn else head
        mine = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/data/{staged}/part={p}" for p in touched))
        keys, _ = broadcast_if_small(mine.select(self.key))

        def step(head: Head):
            run, parts = staged, touched
            old = [p for p in touched if p in head.parts]
            if old:
                known = self.read(old, head).select(self.key).join(keys, self.key, "left_semi")
                if not known.isEmpty():
                    run, parts = self._write(mine.join(known, self.key, "left_anti"))
                    if not parts:
                        self._discard(run)
                        return (head.parts, [], None) if txn else None
            return {**head.parts, **{p: [*head.parts.get(p, []), run] for p in parts}}, [run] if run != staged else [], None

        new = self.change(step, txn)
        if not any(staged in runs for runs in new.parts.values()):
            self._discard(staged)
        crowded = [p for p in touched if len(new.parts.get(p, [])) > self.max_runs]
        return self.fold(crowded) if crowded else new

    def replace(self, parts: list[str], rows: DataFrame, head: Head, txn: tuple[str, int] | None = None, notes: dict[str, str] | None = None) -> Head:
        """Give `parts` the rows `rows`, which were made from `head`; another
        commit since then raises CommitConflict. All other parts stay by name."""
        run, written = self._write(rows)
        kept = {p: r for p, r in head.parts.items() if p not in parts}
        try:
            return self._commit(head, {**kept, **{p: [run] for p in written}}, txn, notes)
        except CommitConflict:
            self._discard(run)
            raise

    def note(self, head: Head, txn: tuple[str, int] | None, notes: dict[str, str]) -> Head:
        """Commit a transaction and notes; all parts stay."""
        return self._commit(head, head.parts, txn, notes)

    def fold(self, parts: list[str]) -> Head:
        """Rewrite `parts` into one run each."""

        def step(head: Head):
            run, written = self._write(self.read(parts, head))
            return {**head.parts, **{p: [run] for p in written}}, [run], None

        return self.change(step)

    def vacuum(self, keep: int = 2, older_than: float = 86400) -> int:
        """Delete files that none of the last `keep` versions names and that are
        older than `older_than` seconds (younger ones may belong to a change in
        progress), and older commits; the number of folders deleted."""
        have = self.versions()
        kept = [self.head(v) for v in have[-keep:]]
        live = {(run, p) for h in kept for p, runs in h.parts.items() for run in runs}
        runs = {run for run, _ in live}
        gone = 0
        for run, at in names(self.spark, f"{self.path}/data"):
            if time.time() - at < older_than:
                continue
            if run not in runs:
                delete(self.spark, f"{self.path}/data/{run}")
                gone += 1
                continue
            for part, _ in names(self.spark, f"{self.path}/data/{run}"):
                if part.startswith("part=") and (run, part.removeprefix("part=")) not in live:
                    delete(self.spark, f"{self.path}/data/{run}/{part}")
                    gone += 1
        for v in have[:-keep]:
            delete(self.spark, self._commit_path(v))
        return gone
