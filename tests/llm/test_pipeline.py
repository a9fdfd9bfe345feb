import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablelearn.llm import langid, pii
from tablelearn.llm.queries import vocabulary
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_neardup import brute as groups

SF = "/root/testdata/sf0.001"


def expected(spark, docs, benchmark):
    """The stages once more, by plain searches over collected rows and the same fitted models."""
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = langid.identify(docs, langid.fit(docs)).collect()
    rows = {r["doc_id"]: rows[r["doc_id"]] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5}
    group = groups(list(rows.items()), 5, 80)
    rows = {i: t for i, t in rows.items() if group[i][1] == i}
    bad = {m[0] for m in leaks(list(rows.items()), [tuple(r) for r in benchmark.select("item_id", "text").collect()])}
    return {i: t for i, t in rows.items() if i not in bad}, len(bad)


@pytest.mark.parametrize("odd", [False, True])
def test_equals_brute_force(spark, tmpdir_path, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sf = SF
    if odd:
        extra = [(10 ** 6, None, None, None, None), (10 ** 6 + 1, "", "en", "s", 0), (10 ** 6 + 2, "123 !!", "en", "s", 6)]
        some = docs.limit(20).selectExpr("doc_id + 2000000 AS doc_id", "text", "lang", "source", "n_chars")
        docs = docs.unionByName(some).unionByName(spark.createDataFrame(extra, docs.schema))
        sf = f"{tmpdir_path}/sf"
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
        docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    rows, n_bad = expected(spark, docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert set(got) == set(rows) and n_bad and len(rows) < docs.count()
    model = pii.fit(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    t = Tokenizer.from_file(vocabulary())
    for i, text in rows.items():
        text = pii.masked(text, pii.all_spans([text], *model)[0][1])
        ids = t.encode(text, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids"] == np.array(ids, "<u4").tobytes(), i
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []


def test_stages_with_a_column_that_differs_by_case_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.selectExpr("doc_id", "'x' AS a", "text", "lang", "source", "n_chars", "7 AS b", "'y' AS id").toDF(
        "doc_id", "Text", "text", "lang", "source", "n_chars", "N_chars", "id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[1] == "x" and r[6] == 7 and r[7] == "y" for r in rows), name
        if name == "redacted":
            assert all(r[5] == len(r[2]) for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
