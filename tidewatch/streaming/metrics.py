"""What a stream drops, counted: records that decode to nothing, records without
a time, and groups behind the watermark.

The first two are observed metrics of the decoding step, computed in the pass
that decodes. The third is Spark's own count of the state operators: rows of a
late record reach the state store folded per group, so it counts groups, not
records. `drops_of` reads them from a progress report; `DropReport` sums them
over a running application.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

DECODED = "decoded"
CAUSES = ("undecodable", "untimed", "late_groups")


def observed(logs: DataFrame) -> DataFrame:
    """Decoded records with their counts: all, those of which nothing decoded,
    and those of which only the time is missing."""
    nothing = F.coalesce(*(F.col(f"`{c}`").cast("string") for c in logs.columns)).isNull()
    return logs.observe(
        DECODED, F.count(F.lit(1)).alias("records"), F.count_if(nothing).alias("undecodable"),
        F.count_if(F.col("ts").isNull() & ~nothing).alias("untimed"))


def drops_of(progress) -> Counter:
    """Records read and dropped in one micro-batch, by cause."""
    out: Counter = Counter(records=0, **dict.fromkeys(CAUSES, 0))
    seen = progress.observedMetrics.get(DECODED)
    if seen is not None:
        out.update({k: seen[k] or 0 for k in ("records", "undecodable", "untimed")})
    out["late_groups"] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    return out


def total_drops(reports: Iterable) -> Counter:
    """The sum over several progress reports."""
    out: Counter = Counter(records=0, **dict.fromkeys(CAUSES, 0))
    for p in reports:
        out.update(drops_of(p))
    return out


class DropReport(StreamingQueryListener):
    """Sums what all streams of an application drop; `emit` gets one JSON line
    for each micro-batch that dropped something."""

    def __init__(self, emit: Callable[[str], None] = print):
        self.total: Counter = Counter()
        self.emit = emit

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        drops = drops_of(event.progress)
        self.total.update(drops)
        if any(drops[c] for c in CAUSES):
            self.emit(json.dumps({"query": str(event.progress.name or event.progress.id), "batch": event.progress.batchId, **drops}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
