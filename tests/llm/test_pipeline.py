import corpus_pipeline as cp
from ledgerloom.llm.common import written


def test_stages_and_run(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in cp.STAGES] == ["quality rules", "toxicity", "SimHash near-duplicates", "source mix", "byte-level BPE"]
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = written(stage(spark, docs, d))
        if k < 4:
            assert docs.columns == names
            now = [r.doc_id for r in docs.select("doc_id").collect()]
            assert set(now) <= ids and (k == 3 or len(now) == len(set(now)))
            ids = set(now)
    out = sorted((r.doc_id, r.ids_sha256) for r in docs.collect())
    assert out == sorted((r.doc_id, r.ids_sha256) for r in cp.run(spark, d).collect())


def test_stages_take_odd_rows(spark):
    d = "/root/testdata/sf0.001"
    long = "word number %d and then some more words follow here to make it a longer line of text"
    rows = [(1, long % 1, "en", "a", 1, "k"), (1, long % 1, "en", "a", 1, "k"), (2, long % 1, "en", "a", 1, "k"), (None, " ".join(f"n{i}" for i in range(40)), None, None, None, None), (3, None, "en", "a", None, None), (4, "", "en", None, None, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __k string")
    for frame in (odd, odd.limit(0)):
        docs = frame
        for k, (name, stage) in enumerate(cp.STAGES):
            docs = written(stage(spark, docs, d))
            if k < 4:
                assert docs.columns == frame.columns
            if frame is odd and name.startswith("SimHash"):
                assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    assert docs.count() == 0


def test_clashing_names_and_long_rows(spark):
    d = "/root/testdata/sf0.001"
    text = lambda i: " ".join(f"word{i}x{k}" for k in range(40))
    rows = [(i, text(i), "en", ["a", "b"][i % 2], 1, i, i, i, i, i) for i in range(40)] + [(3, text(3), "en", "b", 1, 3, 3, 3, 3, 3)] * 3 + [(50, " ".join(f"l{k}" for k in range(400_000)), "en", "a", 1, 0, 0, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, __n int, __k int, __text int, __id int, ___copies int")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        got = {r.doc_id: r for r in out.collect()}
        assert all(r.doc_id == 50 or (r["__n"], r["__k"], r["__text"]) == (r.doc_id,) * 3 for r in got.values())
        if name in ("quality rules", "toxicity", "SimHash near-duplicates"):
            assert set(got) == {*range(40), 50}
    assert cp.near_duplicate_stage(spark, docs, d).count() == 41 and cp.quality_stage(spark, docs, d).count() == 44
    assert all(stage(spark, docs.limit(0), d).count() == 0 for _, stage in cp.STAGES)
