import corpus_pipeline as cp
from tests.llm.conftest import clashing, frame, prose
from tidewatch.llm.textkit import scratch

SF = "/root/testdata/sf0.001"


def inputs(spark, docs, labels, items):
    folder = scratch(spark, "test-pipeline")
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_are_the_named_ones_and_each_takes_effect(spark):
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    docs = {}
    for i in range(240):
        text = "\n".join(". ".join(prose(i * 31 + k * 7 + j, 12, 4000).capitalize() for j in range(2)) + "." for k in range(4))
        docs[i] = " ".join(x + "***" for x in text.split()) if i % 4 == 0 else text
    item = prose(9999, 30, 4000)
    docs[301] = docs[1] + " tail"  # its lines but the last are a repeated run
    docs[302] = docs[2].replace("\n", " ")  # the same words on one line: a near copy of 2
    docs[303] = docs[3] + "\n" + item.upper()  # a benchmark passage
    labels = [(i, int(i % 4 != 0), 0) for i in range(240) if i % 7]
    folder = inputs(spark, list(docs.items()), labels, [(1, item)])
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    now, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in cp.STAGES:
        out = stage(spark, now, folder)
        path = scratch(spark, "test-stage")
        out.write.parquet(path)
        now = spark.read.parquet(path)
        assert name == cp.STAGES[-1][0] or now.columns == columns
        seen.append({r["doc_id"]: r["text"] for r in now.collect()})
    good = {i for i in range(240) if i % 4}
    assert len(good - set(seen[0])) <= 5 and len(set(range(0, 240, 4)) & set(seen[0])) <= 6
    assert seen[1][301] == docs[301].split("\n")[-1] and seen[1][5] == docs[5]
    assert 302 not in seen[2] and 2 in seen[2]
    assert set(seen[2]) - set(seen[3]) == {303}
    assert set(seen[4]) == set(seen[3])


def test_run_equals_the_stages(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in now.select("doc_id").collect()}
    out = cp.run(spark, SF)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} < ids and len({r["text"] for r in rows}) == len(rows)
    assert all(r["mix_rate"] >= 0 for r in rows)


def test_stages_take_odd_rows_and_empty_tables(spark):
    odd = clashing(frame(spark, [(1, None), (2, ""), (None, None), (None, "x y"), (3, "a b"), (3, "a b"), (4, "w " * 20_000)]))
    folder = inputs(spark, [(1, "a")], [(9, 1, 0)], [(None, None)])
    for df in (odd, odd.where("false")):
        for _, stage in cp.STAGES:
            assert stage(spark, df, folder).count() <= df.count()
