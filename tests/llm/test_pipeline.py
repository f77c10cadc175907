"""The pipeline, stage by stage, against brute force on the smallest tables."""

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from test_llm import brute_components, brute_contamination, folded

from shelfpanel.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """What each stage got and gave."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        given, docs = docs, spark.read.parquet(f"{folder}/{name}")
        out[name] = (given, docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(results, spark):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(results[name][1].columns == names for name, _ in corpus_pipeline.STAGES[:-1])


def test_toxic_documents_go(results, spark):
    given, kept = results["toxicity"]
    model = toxicity.train(given, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in toxicity.score(given, model).where("predicted = 0").collect()}
    assert set(texts(kept)) == want


def test_exact_copies_go(results):
    given, kept = (texts(x) for x in results["exact_dedup"])
    last = {}
    for i, t in given.items():
        last[folded(t)] = max(i, last.get(folded(t), i))
    assert set(kept) == set(last.values()) and all(kept[i] == given[i] for i in kept)


def test_near_copies_go(results):
    given, kept = (texts(x) for x in results["near_dedup"])
    ids = sorted(given)
    found = brute_components([given[i] for i in ids], 80)
    assert set(kept) == {ids[root] for _, root in found.values()}


def test_contaminated_documents_go(results, spark):
    given, kept = (texts(x) for x in results["decontaminate"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute_contamination(given.items(), items)
    assert set(kept) == {i for i, (_, hit, _) in found.items() if not hit}


def test_tokens(results):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(queries.vocab_path())
    given, rows = texts(results["bpe"][0]), results["bpe"][1].collect()
    assert {r.doc_id for r in rows} == set(given)
    for r in rows:
        ids = reference.encode(given[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_run_gives_the_last_stage(results, spark):
    assert corpus_pipeline.run(spark, SF).count() == results["bpe"][1].count()
