"""The corpus pipeline: stage by stage on awkward rows, and the whole against its stages' operators."""

import corpus_pipeline as cp
import __spark_entry__ as ent
from tests.conftest import SF001
from tests.llm.test_operators import A, DOCS, folder, odd_rows
from voltframe.llm import decontaminate, jaccard, language, pii


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_copies", "decontaminate", "pii", "mix"]


def test_awkward_rows(spark, tmp_path):
    ent._prepare(spark)
    docs = spark.createDataFrame(odd_rows() + [(50, "write to jo.li3@mail2.example.com or call +1 (212) 555-0199 about it", "en", "src1", 68, None, None, None)], DOCS)
    sf = folder(spark, tmp_path, documents=docs, benchmark=spark.createDataFrame([(1, A)], "item_id long, text string"))
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, sf)
        if name != "mix":
            assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        out.write.parquet(f"{tmp_path}/out{k}")
        now = spark.read.parquet(f"{tmp_path}/out{k}")
        ids = [r.doc_id for r in now.collect()]
        if name == "language":
            assert not {4, 5, 6, 7} & set(ids) and ids.count(9) == 2 and ids.count(2) == 2
        if name == "near_copies":
            assert ids.count(1) == 1 and not {2, 3, None} & set(ids) and ids.count(9) == 2
        if name == "decontaminate":
            assert 1 not in ids and set(range(100, 110)) <= set(ids)
        if name == "pii":
            text = {r.doc_id: r.text for r in now.collect()}[50]
            assert "jo.li3" not in text and "555-0199" not in text and len(text) == 68


def test_run_against_its_operators(spark):
    got = ent.queries()["pipeline"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = language.identify(docs, language.fit(language.training_rows(docs)), {"doc_id": "long"}).where("lang_pred <> 'und'")
    kept = docs.join(kept.select("doc_id"), "doc_id")
    least = jaccard.jaccard_components(kept.select("doc_id", "text")).where("doc_id = component_id")
    kept = kept.join(least.select("doc_id"), "doc_id")
    bad = decontaminate.decontaminate(kept.select("doc_id", "text"), spark.read.parquet(f"{SF001}/benchmark.parquet")).where("contaminated")
    kept = {r.doc_id: r.text for r in kept.join(bad.select("doc_id"), "doc_id", "left_anti").collect()}
    rows = got.collect()
    assert rows and all(pii.protect(kept[r.doc_id])[0] == r.text for r in rows)
    assert set(got.columns) == {*docs.columns, "mix_probability", "mix_weight"} and len({r.doc_id for r in rows}) == len(rows)
    assert 0.2 * len(kept) < len(rows) < 0.9 * len(kept)
