from tidewatch.llm.queries import QUERIES, SQL

#: Queries that SQL cannot express; their tests hold them against brute force or held-out labels.
WITHOUT_SQL = {"op1_quality", "op2_toxicity", "op4_lm_score", "op6_near_duplicates", "op8_domain_mix", "op11_token_alignment", "op12_pack"}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_queries_without_sql_are_the_named_ones():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and set(SQL) <= set(QUERIES)


def test_entry_has_them_and_the_pipeline():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
