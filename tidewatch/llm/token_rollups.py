"""Delta-maintained token counts.

A store under one folder holds additive totals of documents and tokens by
(source, language, tokenizer version). Batches of changes are committed under
an id: inserts, revisions (new counts, possibly a new source or language) and
deletes of (document, version) keys. A commit looks up what the ledger holds
for the keys it changes and writes the signed difference, so totals are plain
sums of the committed differences and never recounted.

Layout: `ledger/run=<r>` (the keys' state after a batch), `deltas/run=<r>`
(signed totals) and `commits/<place>.json` (batch id, its run and its place in the
order, written last). A run has a name of its own, so no second attempt touches
the files of a committed batch, and any text is a batch id. A place is created by
one writer only (sinks/claims.py): of two writers that computed their batches
from the same state the second discards its run and computes again from the
state now there. A batch id that is already committed changes nothing, whatever
it carries; a batch that failed before its commit leaves no trace in the totals
and is simply run again.

Defined results: several changes of a key in one batch count by their highest
`seq` (ties: delete, then larger counts, first); inserting a key that exists
revises it; deleting one that does not is no change; changes without a doc_id
or version are ignored; null source or language form groups of their own; null
and empty texts have zero tokens and still count as documents; groups whose
documents are all gone stay with zeros; empty batches commit.

Scale: the ledger is cut to the batch's documents by a bitmap of their ids, of
bounded size, before its one shuffle on (doc_id, version), so a commit shuffles
about as many ledger rows as it changes; texts are counted where they are read
and never shuffled. Differences are folded to (source, language, version) before
they are written, so a hot source is a few rows a task. The driver handles one
small commit file a batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.textkit import id_column, scratch, stored
from tidewatch.operators.prefilter import key_bitmap, likely_matches
from tidewatch.sinks.claims import CommitConflict, claim, delete, names, read_text

CHANGE = "doc_id long, version string, op string, source string, language string, tokens long, seq long"
_STATE = "doc_id long, version string, alive boolean, source string, language string, tokens long"
_DELTA = "source string, language string, version string, n_docs long, n_tokens long"

#: Tokenizer versions counted by built-in expressions (fixed values).
WORDS = r"[^ \t-\r]+"
PIECES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
VERSIONS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.regexp_count(text, F.lit(WORDS)),
    "pieces-1": lambda text: F.regexp_count(text, F.lit(PIECES)),
}


def bpe_counter(path: str, pattern: str) -> Callable[[Column], Column]:
    """Token counts of a public byte-level BPE vocabulary (a rank file readable
    on every executor); loaded once in a worker process."""

    def count(batches):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pa.array([len(encoding.encode_ordinary(t or "")) for t in texts.to_pylist()], pa.int64())

    from collections.abc import Iterator

    count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(count, "long")


def counted(documents: DataFrame, op: str, seq: int = 0, versions: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Changes that carry the token counts of all documents under all versions."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = F.array(*(F.struct(F.lit(name).alias("version"), f(text).cast("long").alias("tokens")) for name, f in (versions or VERSIONS).items()))
    rows = documents.select(id_column(documents), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("language"), F.explode(each).alias("c"))
    return rows.select("doc_id", "c.version", F.lit(op).alias("op"), "source", "language", "c.tokens", F.lit(seq).cast("long").alias("seq"))


def removed(ids: DataFrame, seq: int = 0, versions: list[str] | None = None) -> DataFrame:
    """Changes that delete documents under all versions."""
    each = F.array(*map(F.lit, versions or list(VERSIONS)))
    null = F.lit(None)
    return ids.select(id_column(ids), F.explode(each).alias("version"), F.lit("delete").alias("op"), null.cast("string").alias("source"), null.cast("string").alias("language"), null.cast("long").alias("tokens"), F.lit(seq).cast("long").alias("seq"))


class TokenRollup:
    def __init__(self, spark: SparkSession, folder: str, tries: int = 20):
        self.spark, self.folder, self.tries = spark, folder.rstrip("/"), tries

    def _commits(self) -> list[dict]:
        """The commit files, in order."""
        at = f"{self.folder}/commits"
        return [json.loads(read_text(self.spark, f"{at}/{n}")) for n in sorted(n for n, _ in names(self.spark, at))]

    def _read(self, kind: str, schema: str, commits: list[dict]) -> DataFrame:
        """Rows of the committed batches, with their place `at` in the order."""
        if not commits:
            return self.spark.createDataFrame([], schema + ", at long")
        places = self.spark.createDataFrame([(c["run"], c["at"]) for c in commits], "run string, at long")
        paths = [f"{self.folder}/{kind}/run={c['run']}" for c in commits]
        rows = self.spark.read.schema(schema + ", run string").option("basePath", f"{self.folder}/{kind}").parquet(*paths)
        return rows.join(F.broadcast(places), "run").drop("run")  # one row a batch

    def committed(self) -> list[str]:
        """Ids of the committed batches, in order."""
        return [c["batch"] for c in self._commits()]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False (and no effect) if its id is already committed."""
        if batch in self.committed():
            return False
        run = uuid.uuid4().hex
        rank = F.struct("seq", (F.col("op") == "delete").alias("last"), "tokens", "source", "language")
        last = changes.where("doc_id is not null and version is not null").groupBy("doc_id", "version").agg(F.max(rank).alias("c"))
        new = last.select("doc_id", "version", (~F.col("c.last")).alias("alive"), "c.source", "c.language", F.coalesce("c.tokens", F.lit(0)).cast("long").alias("tokens"))
        new.write.parquet(f"{self.folder}/ledger/run={run}")
        new = self.spark.read.schema(_STATE).parquet(f"{self.folder}/ledger/run={run}")
        mine = stored(key_bitmap(new, "doc_id"), "rollup-keys")
        signed = lambda df, at, sign: df.select(F.col(f"{at}source"), F.col(f"{at}language"), "version", F.lit(sign).cast("long").alias("n_docs"), (F.col(f"{at}tokens") * sign).alias("n_tokens"))
        for _ in range(self.tries):
            done = self._commits()
            if any(c["batch"] == batch for c in done):  # another writer delivered it
                break
            ledger = self._read("ledger", _STATE, done)
            if done:
                ledger = likely_matches(ledger, "doc_id", mine)
            state = ledger.groupBy("doc_id", "version").agg(F.max_by(F.struct("alive", "source", "language", "tokens"), "at").alias("o"))
            old = new.select("doc_id", "version").join(state, ["doc_id", "version"]).where("o.alive")
            delta = signed(new.where("alive"), "", 1).unionByName(signed(old, "o.", -1))
            delta = delta.groupBy("source", "language", "version").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            delta.write.parquet(f"{self.folder}/deltas/run={run}")
            if claim(self.spark, f"{self.folder}/commits/{len(done):012d}.json", json.dumps({"batch": batch, "run": run, "at": len(done)})):
                return True
            delete(self.spark, f"{self.folder}/deltas/run={run}")
        delete(self.spark, f"{self.folder}/ledger/run={run}")
        if batch in self.committed():
            return False
        raise CommitConflict(f"{self.folder}: lost {self.tries} places to other writers")

    def totals(self) -> DataFrame:
        """(source, language, version, n_docs, n_tokens) over all committed batches."""
        return self._read("deltas", _DELTA, self._commits()).groupBy("source", "language", "version").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def corpus_history(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Totals after a corpus's life so far: every document is inserted; those
    that repeat lines are revised to each line once, those labelled quality 0
    are deleted, in one batch that is delivered twice; deleted documents that
    are not toxic come back with their revised counts."""
    spark = documents.sparkSession
    store = TokenRollup(spark, scratch(spark, "token-rollup"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    once = F.array_distinct(lines)
    slim = documents.withColumn("text", F.array_join(once, "\n"))
    repeats = documents.where(F.size(once) < F.size(lines)).withColumn("text", F.array_join(once, "\n"))
    bad = labels.where("quality = 0").select("doc_id").distinct()
    back = labels.where("quality = 0 and toxic = 0").select("doc_id").distinct()
    second = counted(repeats, "revise", 1).unionByName(removed(bad, 2))
    store.commit("0-insert", counted(documents, "insert"))
    store.commit("1-clean", second)
    store.commit("1-clean", second)
    # Texts stay where they are read: a bitmap of the ids picks likely ones, and
    # their counts are met with the ids themselves.
    likely = likely_matches(slim.select("doc_id", "source", "lang", "text"), "doc_id", key_bitmap(back, "doc_id"))
    store.commit("2-restore", counted(likely, "insert").join(back, "doc_id", "left_semi"))
    return store.totals()
