import random
import time

import numpy as np
import pytest

from brute import contaminated
from callpulse.llm import decontam
from callpulse.llm.common import Words


def texts_and_items(seed):
    r = random.Random(seed)
    vocabulary = ["a", "b", "É", "the", "x9", "Q", "ß"]

    def some(n):
        return " ".join(r.choice(vocabulary) + r.choice(["", "", ",", "-"]) for _ in range(n))

    docs = [some(r.randint(0, 60)) for _ in range(20)] + [None, "", " ,, "]
    items = [(k, some(r.choice([0, 1, 3, 9, 10, 11, 14, 25]))) for k in range(8)]
    items += [(None, "a b c"), (3, "the the the"), (9, None)]
    for _ in range(8):
        k = r.randrange(20)
        docs[k] = f"{docs[k]} {r.choice(items)[1] or ''} {some(3)}"
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [8 << 20, 60])
def test_hits_are_those_of_all_windows(spark, monkeypatch, seed, block):
    monkeypatch.setattr(decontam, "BLOCK", block)
    docs, items = texts_and_items(seed)
    rows = [(i, t, "x") for i, t in enumerate(docs)]
    marked = decontam.contamination(
        spark.createDataFrame(rows, "doc_id long, text string, hits string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert marked.columns == ["doc_id", "text", "n_words", "hits", "items"]
    for row in marked.collect():
        hit = sum(h.end - h.start for h in row.hits)
        assert (row.n_words, hit, row["items"]) == contaminated(docs[row.doc_id], items)


def test_a_passage_in_a_very_long_text(spark):
    r = random.Random(4)
    filler = [f"f{r.randrange(10**6)}" for _ in range(400_000)]
    item = " ".join(f"i{k}" for k in range(30))
    filler[200_000:200_000] = item.split()[5:25]
    marked = decontam.contamination(
        spark.createDataFrame([(1, " ".join(filler))], "doc_id long, text string"),
        spark.createDataFrame([(5, item)], "item_id long, text string"),
    ).first()
    assert [tuple(h) for h in marked.hits] == [(200_000, 200_020)] and marked["items"] == [5]


@pytest.mark.parametrize("unit", ["w", "a b", "one two three four five six seven"])
def test_texts_of_repeated_words_cost_no_more(unit):
    words = (unit.split() * 20_000)[:20_000]
    item = (unit.split() * 800)[:800]
    raw = np.frombuffer(" ".join(["x", *words, "y"]).encode(), np.uint8)
    index = decontam.BenchmarkIndex([1, 2], [" ".join(item), " ".join(["z", *item])])
    began = time.perf_counter()
    found = index.matches(Words(raw, np.array([0, len(raw)]), decontam._WORD))
    assert time.perf_counter() - began < 2
    assert {(int(a), int(b)) for a, b, _ in zip(*found)} == {(1, 20_001)} and sorted(found[2]) == [0, 1]


def test_repeated_rows_of_one_item(spark):
    item = " ".join(f"i{k}" for k in range(12))
    items = spark.createDataFrame([(5, item)] * 50 + [(5, "other words")] * 3, "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {item}"), (1, f"x {item}"), (2, "other words")], "doc_id long, text string")
    found = [(r.doc_id, r["items"], [tuple(h) for h in r.hits]) for r in decontam.contamination(docs, items).collect()]
    assert sorted(found) == [(1, [5], [(1, 13)])] * 2 + [(2, [5], [(0, 2)])]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs, items).first().hits == []
    assert decontam.contamination(docs.where("false"), items).count() == 0
