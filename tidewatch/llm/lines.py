"""Line dedup: a suffix array over line-id sequences by prefix doubling.

A text is split at line feeds; lines of white space only take no part and are
never removed. The other lines of all documents, in the order of (doc_id, hash
of the text, line), form one sequence in which no run crosses a document's
end. A line is removed when it lies in a run of at least `min_lines` lines, or
is itself a line of at least `min_words` words, that also starts earlier in
that order.

1. Every line gets a position (a number that grows along the order) and a
   128-bit id (two 64-bit hashes).
2. Prefix doubling. Level h holds the positions whose first h lines recur,
   with the rank of that prefix: an order-preserving number given by a range
   sort of the distinct (rank, rank h lines on) pairs, together with the
   earliest position of the prefix. A position whose prefix is alone has found
   its place in the suffix array and leaves the later levels, so they shrink
   to what is really repeated.
3. Common prefixes. For each position, the deepest level at which an earlier
   position shares its prefix gives its interval of the suffix array and the
   earliest member; the ranks of the lower levels, compared at both positions,
   extend the run to its full length (binary descent).
4. A line is covered when the furthest end of the runs that start at or before
   it in its document lies behind it. Covered lines are cut from later copies;
   the earliest copy of a run stays.

Only DataFrame operations run here: no Python on the executors.

Defined results: null and empty texts have no lines; equal rows of one doc_id
count once and are cut alike; rows of one doc_id with different texts are
documents of their own, ordered by the hash of their text; rows with a null
doc_id take part in nothing and stay whole; an empty table gives an empty
result; other columns are kept whatever their names.

Scale: a level shuffles 24-byte rows of the repeated positions only, and there
are log2(longest repeated run) levels. Groups are folded before the shuffle
(count, least position), the members find their rank by a sort-merge join
that AQE may split, so a line a third of all documents share is no single
task's load. The text is shuffled once, to bring the cuts to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.textkit import id_column, stored

MIN_LINES = 2
MIN_WORDS = 20


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _filled(line: Column) -> Column:
    return line.rlike(r"[^ \t-\r]")


def line_sequence(documents: DataFrame) -> DataFrame:
    """(g, doc_id, body, i, left, h1, h2, n): the non-blank lines in order. g:
    position; i: index of the line in its text; left: lines from here to the
    document's end; n: words."""
    # \t-\r is 0x09-0x0D
    words = lambda x: F.regexp_count(x, F.lit(r"[^ \t-\r]+"))
    line = lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h1"), F.xxhash64(F.concat(F.lit("#"), x)).alias("h2"), words(x).alias("n"))
    docs = documents.where(id_column(documents).isNotNull()).select(id_column(documents), F.xxhash64("text").alias("body"), F.filter(F.transform(_lines(F.col("text")), line), lambda s: s["n"] > 0).alias("seq"))
    docs = docs.where(F.size("seq") > 0).dropDuplicates(["doc_id", "body"])
    docs = docs.repartitionByRange("doc_id", "body").sortWithinPartitions("doc_id", "body")
    rows = docs.select("doc_id", "body", F.size("seq").alias("m"), F.posexplode("seq").alias("k", "s"))
    return stored(rows.select(F.monotonically_increasing_id().alias("g"), "doc_id", "body", "s.i", (F.col("m") - F.col("k")).alias("left"), "s.h1", "s.h2", "s.n"), "lines")


def _level(members: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(g, rank, first): members whose key is not alone, ranked in key order."""
    groups = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.min("g").alias("first")).where("c > 1").drop("c")
    ranked = stored(groups.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("new", F.monotonically_increasing_id()), f"{name}-ranks")
    return stored(members.join(ranked, keys).select("g", "left", F.col("new").alias("rank"), "first"), name)


def levels(lines: DataFrame) -> dict[int, DataFrame]:
    """h -> (g, left, rank, first) of the positions whose first h lines recur."""
    h, out = 1, {}
    level = _level(lines.select("g", "left", "h1", "h2"), ["h1", "h2"], "level-1")
    while level.limit(1).count():
        out[h] = level
        ahead = level.select((F.col("g") - h).alias("g"), F.col("rank").alias("then"))
        pairs = level.where(F.col("left") > h).select("g", "left", "rank").join(ahead, "g")
        h *= 2
        level = _level(pairs, ["rank", "then"], f"level-{h}")
    return out


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(g, first, n_lines): per position with an earlier copy, the earliest
    position of its deepest repeated prefix and the lines both have in common."""
    found = levels(lines)
    whole = lambda x: F.lit(x).cast("long")
    runs = lines.where("false").select("g", F.col("g").alias("first"), whole(0).alias("n"), whole(0).alias("h"))
    for h, level in found.items():
        runs = runs.unionByName(level.where("first < g").select("g", "first", whole(h).alias("n"), whole(h).alias("h")))
    # A position of level 2h is one of level h too: the deepest level counts.
    runs = runs.groupBy("g").agg(F.max(F.struct("h", "first", "n")).alias("r")).select("g", "r.first", "r.n", "r.h")
    runs = stored(runs, "runs")
    for s in sorted(found, reverse=True)[1:]:
        here = found[s].select((F.col("g")).alias("a"), F.col("rank").alias("ra"))
        there = found[s].select((F.col("g")).alias("b"), F.col("rank").alias("rb"))
        deep = runs.where(F.col("h") > s)
        deep = deep.withColumn("a", F.col("g") + F.col("n")).join(here, "a").withColumn("b", F.col("first") + F.col("n")).join(there, "b")
        longer = deep.where("ra = rb").select("g", whole(s).alias("more"))
        runs = stored(runs.join(longer, "g", "left").select("g", "first", (F.col("n") + F.coalesce("more", whole(0))).alias("n"), "h"), f"runs-{s}")
    return runs.select("g", "first", F.col("n").alias("n_lines"))


def removed_lines(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, body, gone, n): per document that loses lines the removed index
    ranges [a, b) of its lines, in order, and the number of lines removed."""
    lines = line_sequence(documents)
    runs = repeated_runs(lines)
    here = lines.select("g", "doc_id", "body", "i", "n").join(runs, "g", "left")
    ends = F.when((F.col("n_lines") >= min_lines) | (F.col("n_lines").isNotNull() & (F.col("n") >= min_words)), F.col("g") + F.when(F.col("n_lines") >= min_lines, F.col("n_lines")).otherwise(F.lit(1)))
    doc = Window.partitionBy("doc_id", "body").orderBy("g")
    covered = here.withColumn("until", F.max(ends).over(doc.rowsBetween(Window.unboundedPreceding, 0))).where("until > g")
    island = covered.withColumn("at", F.col("i") - F.row_number().over(doc)).groupBy("doc_id", "body", "at").agg(F.min("i").alias("a"), (F.max("i") + 1).alias("b"))
    return island.groupBy("doc_id", "body").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("gone"), F.sum(F.col("b") - F.col("a")).alias("n"))


def _cut(documents: DataFrame, min_lines: int, min_words: int) -> tuple[DataFrame, Column]:
    """The documents with `__gone`, `__n`, and the text that is left."""
    lost = removed_lines(documents, min_lines, min_words).select(F.col("doc_id").alias("__id"), F.col("body").alias("__body"), F.col("gone").alias("__gone"), F.col("n").alias("__n"))
    rows = documents.join(lost, (id_column(documents) == F.col("__id")) & (F.xxhash64(documents["text"]) == F.col("__body")), "left")
    all_lines, gone = _lines(F.col("text")), F.col("__gone")
    start = lambda j: F.coalesce(F.get(gone, j - 1)["b"], F.lit(0))
    stop = lambda j: F.coalesce(F.get(gone, j)["a"], F.size(all_lines))
    parts = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda j: F.slice(all_lines, start(j) + 1, F.greatest(stop(j) - start(j), F.lit(0))))
    return rows, F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))


def without_repeated_lines(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the later copies of repeated line runs cut out."""
    rows, text = _cut(documents, min_lines, min_words)
    return rows.withColumn("text", text).select(*(F.col(f"`{c}`") for c in documents.columns))


def line_digest(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: its non-blank lines, those removed, sha256 of the text left."""
    rows, text = _cut(documents.select(id_column(documents), "text"), min_lines, min_words)
    n = F.size(F.filter(_lines(F.col("text")), _filled))
    return rows.select("doc_id", n.cast("long").alias("n_lines"), F.coalesce("__n", F.lit(0)).cast("long").alias("n_removed"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("kept_sha256"))
