import os
import re
import tempfile

import corpus_pipeline
import pytest

from linkledger.llm.mixing import mix_sources
from linkledger.llm.toxicity import toxicity

from .cases import DOCS, odd_docs
from .test_packing import plain_best_fit
from .test_simhash import closure, plain_fingerprint
from .test_toxicity import corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark):
    """Documents with toxic ones, exact copies and rows of every odd kind."""
    folder = tempfile.mkdtemp(prefix="linkledger-pipeline-test-")
    docs, labels = corpus(spark, 200)
    copies = docs.where("doc_id % 5 = 1").selectExpr("doc_id + 1000 as doc_id", "replace(text, ' ', '  ') as text", "lang",
                                                     "source", "n_chars")
    odd = odd_docs(spark, clash=False).selectExpr("doc_id + 5000 as doc_id", "text", "lang", "source", "n_chars")
    docs.unionByName(copies).unionByName(odd).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_are_as_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_does_its_work_on_what_it_gets(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got = [tuple(r) for r in docs.collect()]
        if name == "toxicity":
            before = spark.read.parquet(f"{sf_dir}/documents.parquet")
            gone = [r["doc_id"] for r in toxicity(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
                    if r["predicted"]]
            assert gone and sorted(got, key=str) == sorted((r for r in rows if r[0] not in gone), key=str)
        elif name == "exact_dedup":
            first = {}
            for r in rows:
                text = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
                first[text] = min(first.get(text, r), r, key=lambda x: (x[0] is None, x[0]))
            assert len(first) < len(rows) and sorted(got, key=str) == sorted(first.values(), key=str)
        elif name == "simhash_dedup":
            prints = [plain_fingerprint(r[1]) for r in rows]
            keys = sorted(set(prints))
            group = closure(keys, [(x, y) for i, x in enumerate(keys) for y in keys[i + 1:] if (x ^ y).bit_count() <= 2])
            least = {}
            for r, fp in zip(rows, prints):
                if r[0] is not None:
                    least[group[fp]] = min(least.get(group[fp], r[0]), r[0])
            want = [r for r, fp in zip(rows, prints) if r[0] is None or r[0] == least[group[fp]]]
            assert sorted(got, key=str) == sorted(want, key=str)
        elif name == "mixing":
            copies = {r["doc_id"]: r["copies"] for r in mix_sources(spark.createDataFrame(rows, DOCS)).collect()}
            want = [r for r in rows for _ in range(copies[r[0]])]
            assert sorted(got, key=str) == sorted(want, key=str)
        else:
            pieces = docs.collect()
            assert sorted((p["doc_id"] for p in pieces if p["piece"] == 0), key=str) == sorted((r[0] for r in rows), key=str)
            assert len({p["sequence_id"] for p in pieces}) == plain_best_fit(
                [p["length"] for p in pieces if p["length"] < 4096], 4096) + sum(p["length"] == 4096 for p in pieces)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
        rows = got


def test_run_gives_the_rows_of_the_last_stage_and_survives_an_empty_table(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    empty = tempfile.mkdtemp(prefix="linkledger-pipeline-test-")
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert os.path.isdir(empty)


def test_extra_columns_with_clashing_names_go_through(spark, sf_dir):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    assert docs.columns == odd_docs(spark).columns and corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
