import pytest

cp = pytest.importorskip("corpus_pipeline")


def test_stages_on_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, sf)
        if i < len(cp.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
        sizes.append(docs.count())
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    assert sizes[1] == sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    assert docs.columns[0] == "doc_id" and "sequence_id" in docs.columns


def test_odd_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "!!", "en", "a", 2), (4, "Mail me at a@b.co today, please do", "en", "a", 9), (5, "Mail me at a@b.co today, please do", None, "b", 9), (5, "Mail me at a@b.co today, please do", None, "b", 9), (6, "Bonjour à tous les amis", "fr", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(cp.STAGES)
    kept = stages["language_id"](spark, docs, sf)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 5, 6]
    one = stages["near_duplicates"](spark, kept, sf)
    assert sorted(r.doc_id for r in one.collect()) == [4, 6]
    clean = {r.doc_id: r for r in stages["pii"](spark, one, sf).collect()}
    assert clean[4].text == "Mail me at <EMAIL> today, please do" and clean[4].n_chars == len(clean[4].text) and clean[6].text == "Bonjour à tous les amis"
    assert stages["packing"](spark, stages["mixing"](spark, docs, sf), sf).count() > 0
    null = stages["pii"](spark, docs.where("doc_id = 1"), sf).first()
    assert null.text is None
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0


def test_run(spark, sf):
    out = cp.run(spark, sf)
    assert out.count() > 0
