"""The registered queries of the training-data operators and their SQL.

Each query applies its operator with production parameters to the whole of its
table and returns the operator's full result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.textkit import package_on_workers, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        @wraps(f)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            package_on_workers(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = query
        if sql:
            SQL[f.__name__] = sql
        return query

    return add


@_query("""
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
      FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 20
""")
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.topk import exact_top_k, vectors

    all_rows = vectors(read(spark, sf_dir, "embeddings"))
    return exact_top_k(all_rows, all_rows.where("vec_id % 20 = 0"))


@_query(r"""
WITH norm AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT id AS item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (
  SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM norm, sizes WHERE len(w) >= n)),
hit AS (SELECT g.id, g.i, g.n, v.item FROM gram g JOIN win v ON g.n = v.n AND g.t = v.t),
covered AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hit) GROUP BY id)
SELECT norm.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN covered USING (id) LEFT JOIN items USING (id)
""")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.decontaminate import contamination

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
o AS (SELECT t, min(doc_id) AS first_doc FROM g GROUP BY t),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT g.doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN o USING (t) WHERE first_doc < g.doc_id)),
each AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.substrings import repeat_digest

    return repeat_digest(read(spark, sf_dir, "documents"))


@_query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i, l[i] AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
f AS (SELECT doc_id, i, t, len(regexp_extract_all(t, '[^ \t-\r]+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM x
      WHERE regexp_matches(t, '[^ \t-\r]')),
p AS (SELECT a.doc_id, a.k, a.t AS t1, b.t AS t2 FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.k = a.k + 1),
pair AS (SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY t1, t2 ORDER BY doc_id, k) AS c FROM p) WHERE c > 1),
long AS (SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, k) AS c FROM f WHERE n >= 20) WHERE c > 1),
gone AS (SELECT doc_id, k FROM pair UNION SELECT doc_id, k + 1 FROM pair UNION SELECT doc_id, k FROM long),
cut AS (SELECT f.doc_id, f.i FROM f JOIN gone USING (doc_id, k)),
kept AS (SELECT doc_id, string_agg(t, chr(10) ORDER BY i) AS t FROM x ANTI JOIN cut USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM f GROUP BY doc_id), r AS (SELECT doc_id, count(*) AS r FROM cut GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.lines import line_digest

    return line_digest(read(spark, sf_dir, "documents"))


@_query()
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


@_query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.quality import quality_scores

    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.toxicity import toxicity_scores

    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query()
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.mixing_lm import score_documents

    return score_documents(read(spark, sf_dir, "documents"))


_PIECES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


@_query(rf"""
WITH d AS (SELECT doc_id, source, lang AS language, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
t AS (SELECT *, array_to_string(list_distinct(l), chr(10)) AS once, len(list_distinct(l)) < len(l) AS repeats FROM d),
c AS (SELECT doc_id, source, language, v, repeats,
        CASE v WHEN 'words-1' THEN len(regexp_extract_all(text, '[^ \t-\r]+')) ELSE len(regexp_extract_all(text, '{_PIECES}')) END AS whole,
        CASE v WHEN 'words-1' THEN len(regexp_extract_all(once, '[^ \t-\r]+')) ELSE len(regexp_extract_all(once, '{_PIECES}')) END AS slim
      FROM t, (VALUES ('words-1'), ('pieces-1')) AS versions(v)),
b AS (SELECT doc_id, bool_or(toxic = 0) AS again FROM labels WHERE quality = 0 GROUP BY doc_id),
e AS (SELECT c.*, CASE WHEN b.doc_id IS NULL THEN 1 WHEN again THEN 1 ELSE 0 END AS alive,
             CASE WHEN b.doc_id IS NULL THEN (CASE WHEN repeats THEN slim ELSE whole END) WHEN again THEN slim ELSE 0 END AS n
      FROM c LEFT JOIN b USING (doc_id))
SELECT source, language, v AS version, sum(alive)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM e GROUP BY ALL
""")
def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.token_rollups import corpus_history

    return corpus_history(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query()
def op8_domain_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.llm.domain_mix import mix_rates

    return mix_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from tidewatch.llm.alignment import align_tokenizers

    return align_tokenizers(read(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


@_query()
def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from tidewatch.llm.packing import pack

    return pack(read(spark, sf_dir, "documents"), path("byte_bpe_50k.json")).drop("ids")


@_query("""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE label = own) WHERE k <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS k
      FROM p JOIN s ON p.anchor_id = s.anchor_id
      WHERE s.label <> s.own AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tidewatch.llm.negatives import hard_negatives, labelled_vectors

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = labelled_vectors(read(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))
