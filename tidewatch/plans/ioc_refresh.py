"""Incremental indicator refresh: raw landing area -> clean table.

Layout of a table folder:

    snapshots/<version>-<run>/part-*.parquet  immutable, one per run
    _commits/<version>.json                   the commit of that version:
                                              snapshot, marker (last landing
                                              day merged)

A run reads the landing days from the marker on (files may land late in the
marked day; merging rows again changes nothing), merges them into the current
snapshot (one row per indicator id), writes a NEW snapshot under a name of its
own and only then its commit. A commit file is created by one run only
(sinks/claims.py): of two runs that read the same version, however their steps
interleave, the second fails and leaves the first's table as it is. A run that dies before the commit changes nothing either. Readers
resolve the latest commit, so they never see a half-written table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.iocs import batch_per_id, clean_iocs, explode_raw, merge_iocs
from tidewatch.plans.landing import changed_rows
from tidewatch.session import checkpoint_root
from tidewatch.sinks.claims import CommitConflict, claim, delete
from tidewatch.sources.iocs import COMMITS, SNAPSHOTS, last_commit, read_commits, read_iocs, read_raw


@dataclass(frozen=True)
class RefreshResult:
    version: int | None
    marker: dt.date | None
    changed: bool


def run_ioc_refresh(
    spark: SparkSession,
    raw_base: str,
    table: str,
    shift_hours: int = 3,
    reread_marker_day: bool = True,
    keep_snapshots: int | None = None,
) -> RefreshResult:
    """One incremental run. `reread_marker_day=False` skips files that landed
    in the last merged day after its run. `keep_snapshots` deletes older
    snapshots after the commit (readers of those lose their files)."""
    prior = last_commit(spark, table)
    marker = None if prior is None else prior["marker"]
    batch = read_raw(spark, raw_base, after=marker, inclusive=reread_marker_day)
    # The latest landing day is observed in the pass that folds the increment.
    seen = Observation("increment")
    batch = batch.observe(seen, F.max("folder_date").alias("marker"), F.count(F.lit(1)).alias("documents"))
    cleaned = clean_iocs(explode_raw(batch), shift_hours)
    checkpoint_root(spark)
    folded = batch_per_id(cleaned).checkpoint(eager=True)  # reads the increment once
    new_marker = max((d for d in (marker, seen.get["marker"]) if d is not None), default=None)
    current = read_iocs(spark, table)
    if not seen.get["documents"] or (new_marker == marker and current is not None and not changes(current, folded)):
        return RefreshResult(None if prior is None else prior["version"], marker, False)

    merged = merge_iocs(current, folded, unique=True)
    version = 0 if prior is None else prior["version"] + 1
    snapshot = f"{version:010d}-{uuid.uuid4().hex[:8]}"
    path = f"{table}/{SNAPSHOTS}/{snapshot}"
    merged.write.mode("errorifexists").parquet(path)
    commit = {"version": version, "snapshot": snapshot, "marker": None if new_marker is None else str(new_marker),
              "committed_at": dt.datetime.now(dt.timezone.utc).isoformat()}
    if not claim(spark, f"{table}/{COMMITS}/{version:010d}.json", json.dumps(commit)):
        delete(spark, path)
        raise CommitConflict(f"version {version} of {table} already exists")
    if keep_snapshots:
        rows = read_commits(spark, table).orderBy(F.desc("version")).select("snapshot").collect()
        for r in rows[max(1, keep_snapshots):]:
            delete(spark, f"{table}/{SNAPSHOTS}/{r['snapshot']}")
    return RefreshResult(version, new_marker, True)


def changes(current: DataFrame, folded: DataFrame) -> bool:
    """Whether a folded increment has an id the table lacks or saw later. The
    ids of a small increment meet the table first, so the table is not shuffled."""
    return not changed_rows(current, folded).isEmpty()

