"""The pipeline stage by stage on a small table with awkward rows, and as a whole."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from llm_helpers import docs, sentence
from test_decontam import brute as contaminated
from test_near_dup import brute_classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, sentence("item", 20)), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    marks = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def good(i, n=60):
    return sentence(("good", i), n).capitalize() + "."


def bad(i):
    return " ".join(w.upper() + "!!" for w in sentence(("bad", i), 60).split())


def test_quality_drops_what_it_rejects(spark, sf_dir):
    rows = [(i, good(i)) for i in range(60)] + [(100 + i, bad(i)) for i in range(60)] + [(None, good("null id")), (200, good(3)), (200, good(3))]
    table = docs(spark, rows)
    out = cp.quality_filter(spark, table, sf_dir)
    assert out.columns == table.columns
    kept = sorted(str(r.doc_id) for r in out.collect())
    assert kept == sorted(str(i) for i, t in rows if not t.isupper() and "!!" not in t)
    assert cp.quality_filter(spark, table.where("false"), sf_dir).count() == 0
    unknown = docs(spark, [(900, "x y"), (901, None)])  # none of them is labelled
    assert cp.quality_filter(spark, unknown, sf_dir).count() == 2


def test_lines_go_and_documents_stay(spark, sf_dir):
    rows = [(i, f"menu\n{good(i)}\nfooter", "en", "a") for i in range(9)] + [(20, "menu", "en", "a"), (21, None, "en", "a"), (22, "menu", "en", "b")]
    table = docs(spark, rows)
    out = cp.drop_common_lines(spark, table, sf_dir)
    assert out.columns == table.columns and out.dtypes == table.dtypes
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {i: good(i) for i in range(9)} | {20: "", 21: None, 22: "menu"}
    assert out.where("n_chars <> length(text)").count() == 0


def test_one_document_of_each_group_stays(spark, sf_dir):
    base = sentence("base", 120)
    near = base.replace(" ", " extra ", 1)
    rows = [(5, base), (3, near), (9, base), (9, base), (4, good(1)), (4, good(2)), (None, base), (7, None), (8, None), (None, None), (6, ""), (2, "")]
    rows += [(50, good(50)), (50, good(50))]
    table = docs(spark, rows)
    out = cp.keep_one_of_group(spark, table, sf_dir)
    assert out.columns == table.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    groups = [sorted(rows[i][1] or "" for i in g) for g in brute_classes(rows)]
    assert len(kept) == len(groups)
    for g in groups:  # one text of every group
        assert sum((t or "") in g for _, t in kept) >= 1
    assert sum(t in (base, near) for _, t in kept) == 1 and {t for i, t in kept if i == 4} == {good(1), good(2)}
    assert sum(t is None for _, t in kept) == 3 and cp.keep_one_of_group(spark, table.where("false"), sf_dir).count() == 0


def test_contaminated_documents_go(spark, sf_dir):
    item = sentence("item", 20)
    rows = [(1, good(1)), (2, good(2) + " " + " ".join(item.split()[4:15])), (3, " ".join(item.split()[:9])), (None, item), (5, None), (6, ""), (2, good(4))]
    table = docs(spark, rows)
    out = cp.decontaminate(spark, table, sf_dir)
    assert out.columns == table.columns
    want = [(i, t) for i, t in rows if not contaminated(t, [(1, item)])[4]]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str) and len(want) == 5


def test_stages_and_packing(spark, sf_dir):
    assert [f for _, f in cp.STAGES] == [cp.quality_filter, cp.drop_common_lines, cp.keep_one_of_group, cp.decontaminate, cp.pack]
    out = cp.pack(spark, docs(spark, [(1, good(1)), (2, None)]), sf_dir)
    assert {r.doc_id for r in out.collect()} == {1, 2} and out.where("doc_id = 2").first().length == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables absent")
def test_whole_run(spark):
    out = cp.run(spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    kept = out.select("doc_id").distinct()
    assert 0 < kept.count() < documents.count() and kept.join(documents, "doc_id", "left_anti").count() == 0
    whole = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n <> t").count() == 0
