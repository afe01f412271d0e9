"""Mixing a corpus to target domain weights by soft membership.

Domains are the classes of a labelled table. A naive Bayes classifier learnt
from it gives every document a posterior over the domains; the expected tokens
of a domain are the sum of rate * tokens * posterior over the documents.
Nonnegative rates are fitted so that these match the targets: projected
gradient descent on

    sum over domains of (expected tokens - target)^2 / (2 * tokens of the domain at rate 1)

from rate 1 for all, with steps scaled by 1 / tokens per document. In that
metric the largest curvature is 1, so unit steps descend, and the fit stays
close to where it began: a document's rate moves with its posteriors only.

Features of a text are its words (in 2**`bits` hash slots) and the last
character of each word. Log-likelihoods of a text are divided by the square
root of its word count, as words of one text are not independent.

Only DataFrame operations run here: no Python on the executors.

Defined results: null and empty texts have no words, the prior as posterior
and zero tokens, and get the rate that posterior implies; domains that the
labelled rows lack are left out and the other targets rescaled; without
labelled rows all rates are 1 and the domain is null; conflicting labels of
one doc_id count as the largest domain name; repeated rows of one doc_id each
count and get equal rates; rows with a null doc_id are mixed like others, never
learnt from; other columns are kept, earlier mix_* columns replaced.

Scale: words become one row each inside the scan task, meet two broadcast
tables of fixed size, and are summed per document before the shuffle, which
carries one row a document and task. An iteration is one map-side sum to
as many numbers as there are domains. Learning takes the `labelled_rows`
labelled rows with the smallest id hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textkit import id_column, stored

LABELLED_ROWS = 40_000
BITS = 16
#: Share of all tokens each domain should have: q = quality label, t = toxic label.
TARGETS = {"q1t0": 0.90, "q0t0": 0.08, "q1t1": 0.02, "q0t1": 0.00}
_ROUNDS_A_STORE = 6


def label_domain() -> Column:
    return F.concat(F.lit("q"), F.col("quality").cast("int").cast("string"), F.lit("t"), F.col("toxic").cast("int").cast("string"))


def _features(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """One row per word: keys, slot (word hash), tail (last character)."""
    word = F.explode(F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+", -1), lambda x: x != ""))
    return rows.select(*keys, word.alias("w")).select(*keys, F.pmod(F.xxhash64("w"), F.lit(1 << bits)).alias("slot"), F.pmod(F.ascii(F.right("w", F.lit(1))), F.lit(128)).cast("long").alias("tail"))


def _likelihoods(counted: DataFrame, key: str, size: int, names: list[str], totals: dict[str, int]) -> DataFrame:
    """(key, l0..): smoothed log-likelihood of each feature value per domain,
    for the values seen; the others share the floor that _floor gives."""
    wide = counted.groupBy(key).pivot("domain", names).agg(F.sum("n"))
    return wide.select(key, *(F.log((F.coalesce(F.col(f"`{d}`"), F.lit(0)) + F.lit(0.5)) / F.lit(totals[d] + 0.5 * size)).alias(f"{key}_{i}") for i, d in enumerate(names)))


def posteriors(documents: DataFrame, labels: DataFrame, domain: Column | None = None, labelled_rows: int = LABELLED_ROWS, bits: int = BITS) -> tuple[list[str], DataFrame | None]:
    """(domain names, per (doc_id, body): rows, n tokens of one row, p array)."""
    docs = documents.select(id_column(documents), F.xxhash64("text").alias("body"), F.col("text"))
    known = labels.select(id_column(labels), (label_domain() if domain is None else domain).alias("domain")).where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows), "labelled")
    train = docs.join(F.broadcast(known), "doc_id")  # labelled_rows ids at most
    counts = stored(_features(train, ["domain"], bits).groupBy("domain", "slot", "tail").agg(F.count(F.lit(1)).alias("n")), "domain-words")
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    seen = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(seen)
    if not names:
        return [], None
    totals = {d: totals.get(d, 0) for d in names}
    tables = {"slot": stored(_likelihoods(counts, "slot", 1 << bits, names, totals), "slots"), "tail": stored(_likelihoods(counts, "tail", 128, names, totals), "tails")}
    floor = lambda key, d: F.log(F.lit(0.5 / (totals[d] + 0.5 * {"slot": 1 << bits, "tail": 128}[key])))
    words = _features(docs, ["doc_id", "body"], bits)
    for key, table in tables.items():
        words = words.join(F.broadcast(table), key, "left")  # 2**bits and 128 rows at most
    score = lambda i, d: F.coalesce(F.col(f"slot_{i}"), floor("slot", d)) + F.coalesce(F.col(f"tail_{i}"), floor("tail", d))
    sums = words.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("words"), *(F.sum(score(i, d)).alias(f"l{i}") for i, d in enumerate(names)))
    # Equal rows share a group: their words are summed together and divided out.
    rows = docs.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("rows"))
    both = rows.alias("r").join(sums.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("r.body").eqNullSafe(F.col("s.body")), "left")
    n = F.coalesce(F.col("words") / F.col("rows"), F.lit(0.0))
    total = sum(seen.values())
    logit = [F.log(F.lit(seen[d] / total)) + F.coalesce(F.col(f"l{i}"), F.lit(0.0)) / F.col("rows") / F.sqrt(F.greatest(n, F.lit(1.0))) for i, d in enumerate(names)]
    each = both.select("r.doc_id", "r.body", "rows", n.alias("n"), F.array(*logit).alias("z"))
    odds = F.transform("z", lambda z: F.exp(z - F.array_max("z")))
    each = each.withColumn("odds", odds)
    p = F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda a, b: a + b))
    return names, stored(each.select("doc_id", "body", "rows", "n", p.alias("p")), "posteriors")


def fitted_rates(members: DataFrame, names: list[str], targets: dict[str, float], tolerance: float = 1e-6, rounds: int = 60) -> DataFrame:
    """`members` (rows, n, p) with the column rate."""
    k = range(len(names))
    p = [F.col("p")[i] for i in k]
    mass = F.col("rows") * F.col("n")
    start = members.agg(F.sum(mass), *(F.sum(mass * p[i]) for i in k)).first()
    total, own = float(start[0] or 0), [float(x or 0) for x in start[1:]]
    wanted = [max(0.0, float(targets.get(d, 0))) for d in names]
    scale = sum(wanted)
    now = members.withColumn("rate", F.lit(1.0))
    if not total or not scale:
        return now
    wanted = [w / scale * total for w in wanted]
    expected = own
    for step in range(1, rounds + 1):
        if max(abs(e - w) for e, w in zip(expected, wanted)) <= tolerance * total:
            break
        pull = [(e - w) / max(o, 1e-9 * total) for e, w, o in zip(expected, wanted, own)]
        now = now.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - reduce(lambda a, b: a + b, (F.lit(x) * p[i] for i, x in enumerate(pull)))))
        if step % _ROUNDS_A_STORE == 0:  # the expression would grow without end
            now = stored(now, "rates")
        got = now.agg(*(F.sum(mass * F.col("rate") * p[i]) for i in k)).first()
        expected = [float(x or 0) for x in got]
    return now


def mixed(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: Column | None = None, labelled_rows: int = LABELLED_ROWS, bits: int = BITS) -> DataFrame:
    """The documents with `mix_domain` (the likeliest), `mix_tokens` and
    `mix_rate` (how often the document is to be drawn)."""
    documents = documents.drop("mix_domain", "mix_tokens", "mix_rate")
    names, members = posteriors(documents, labels, domain, labelled_rows, bits)
    if members is None:
        n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t-\r]+", -1), lambda x: x != ""))
        return documents.withColumns({"mix_domain": F.lit(None).cast("string"), "mix_tokens": n.cast("long"), "mix_rate": F.lit(1.0)})
    rates = fitted_rates(members, names, TARGETS if targets is None else targets)
    best = F.element_at(F.array(*map(F.lit, names)), F.array_position("p", F.array_max("p")).cast("int"))
    rates = rates.select(F.col("doc_id").alias("__id"), F.col("body").alias("__body"), best.alias("mix_domain"), F.col("n").cast("long").alias("mix_tokens"), F.col("rate").alias("mix_rate"))
    return documents.join(rates, id_column(documents).eqNullSafe(F.col("__id")) & F.xxhash64(documents["text"]).eqNullSafe(F.col("__body"))).drop("__id", "__body")


def mix_rates(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Per document row: doc_id, domain, n_tokens, rate."""
    names, members = posteriors(documents, labels)
    if members is None:
        rows = mixed(documents, labels, targets)
        return rows.select(id_column(rows), F.col("mix_domain").alias("domain"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_rate").alias("rate"))
    best = F.element_at(F.array(*map(F.lit, names)), F.array_position("p", F.array_max("p")).cast("int"))
    rates = fitted_rates(members, names, TARGETS if targets is None else targets).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rates.select("doc_id", best.alias("domain"), F.col("n").cast("long").alias("n_tokens"), "rate")
