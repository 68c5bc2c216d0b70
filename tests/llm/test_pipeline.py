"""The pipeline against its parts restated, and over awkward rows."""


import public_tokenizers
import pytest
from llm_cases import awkward, near_components, table
from tokenizers import Tokenizer

import corpus_pipeline
from toolgauge.llm import rows, toxicity, weak_rules

SF_DIR = "/root/testdata/sf0.01"


def test_pipeline_restated(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in weak_rules.judge(rows.texts(docs)).filter("kept").collect()}
    kept = docs.filter(docs.doc_id.isin(list(good)))
    kept.write.parquet(f"{tmp_path}/good")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score(spark.read.parquet(f"{tmp_path}/good"), labels)
    clean = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    texts = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in clean)
    first = {}
    for doc_id, text in texts:
        first.setdefault(" ".join(text.split(" ")), (doc_id, text))
    left = sorted(first.values())
    one = [pair for i, (pair, (_, root)) in enumerate(zip(left, near_components([t for _, t in left], 80, 5))) if i == root]
    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {doc_id: len(reader.encode(text, add_special_tokens=False).ids) + 1 for doc_id, text in one}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == expected
    assert sum(r.length for r in got) == sum(expected.values())


@pytest.mark.parametrize("size", [80, 0])
def test_stages_take_awkward_rows(spark, tmp_path, size):
    table(spark, tmp_path / "documents.parquet", awkward(9, size) if size else [])
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert after.columns == docs.columns and after.count() <= docs.count()
        docs = after


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "exact_dedup", "near_dedup", "packing"]
