"""The pipeline against plain Python, stage by stage, on each stage's own input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import contaminated, linked, secrets
from callpulse.llm.common import stored
from test_packing import pieces_of

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        seen[name] = docs
    return seen


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_the_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing",
    ]


def test_columns_are_kept(stages):
    names = [name for name, _ in corpus_pipeline.STAGES][:-1]
    assert all(stages[n].dtypes == stages["documents"].dtypes for n in names)


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = texts(stages["toxicity"])
    assert kept.items() <= texts(stages["documents"]).items()
    toxic, clean = ([i for i, t in labels.items() if t == v] for v in (1, 0))
    # So small a table has a few dozen toxic labels to learn from.
    assert sum(i in kept for i in toxic) <= 0.4 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_one_document_of_each_group_stays(stages):
    before = texts(stages["toxicity"])
    expected = {i for i, (_, c) in linked(before.items()).items() if i == c}
    assert set(texts(stages["near_duplicates"])) == expected


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(stages["near_duplicates"])
    expected = {i for i, t in before.items() if not contaminated(t, items)[1]}
    assert set(texts(stages["decontamination"])) == expected and len(expected) < len(before)


def test_secrets_are_redacted_and_documents_stay(stages):
    before, after = texts(stages["decontamination"]), texts(stages["secrets"])
    assert before.keys() == after.keys()
    held = {i for i, t in before.items() if secrets(t)}
    assert held and not any(secrets(after[i]) for i in held)
    assert sum(before[i] != after[i] for i in before) - len(held) <= 2
    for r in stages["secrets"].collect():
        assert r.n_chars == len(r.text) or before[r.doc_id] == r.text


def test_all_pieces_are_packed(stages):
    found = stages["packing"].collect()
    expected = [
        (i, p, a, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, t in texts(stages["secrets"]).items()
        for p, a, ids in pieces_of(t)
    ]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)


def test_odd_rows_and_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    names = ["toxicity", "hits", "items", "findings", "bands", "rest", "kept", "a.b"]
    docs = docs.select("*", *(F.lit("own").alias(n) for n in names))
    odd = [(None, None), (None, ""), (None, "same text of no id"), (None, "same text of no id"), (10**9, None)]
    rows = spark.createDataFrame(odd, "doc_id long, text string")
    docs = docs.unionByName(rows, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), f"odd-{name}")
        if name != "packing":
            assert docs.dtypes == before.dtypes
            assert docs.where("doc_id is null").count() == 4
    assert docs.where("doc_id is null").count() == 4


def test_repeated_rows_leave_one(spark):
    t, u = "one two three four five six", "quite another text of some more words"
    rows = [(3, t, "a"), (3, t, "a"), (3, u, "a"), (9, t, "b"), (None, t, "c"), (None, t, "c"), (4, None, "d"), (4, None, "d"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.dtypes == docs.dtypes
    found = sorted(((r[0], r[1]) for r in kept.collect()), key=str)
    assert found == sorted([(3, t), (3, u), (None, t), (None, t), (4, None), (5, "")], key=str)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"empty-{name}")
        assert docs.count() == 0
