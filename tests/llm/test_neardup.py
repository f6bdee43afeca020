import random

import numpy as np
import pytest

from brute import linked, shingles
from callpulse.llm import neardup
from callpulse.llm.components import components

SCHEMA = "doc_id long, text string, bands string, hub long"


def family(r, size, words=60):
    """Copies of one text with ever more words changed, as chains and stars."""
    vocabulary = [f"w{k}" for k in range(400)]
    base = r.choices(vocabulary, k=words)
    texts = []
    for _ in range(size):
        own = list(base if r.random() < 0.7 or not texts else r.choice(texts).split())
        for _ in range(r.randrange(0, 4)):
            own[r.randrange(len(own))] = r.choice(vocabulary)
        texts.append(" ".join(own))
    return texts


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "x", i) for i, t in rows], SCHEMA)
    return [tuple(r) for r in neardup.linked_documents(df).collect()]


def test_links_are_those_of_all_pairs(spark):
    r = random.Random(5)
    texts = family(r, 60) + family(r, 40, 20) + family(r, 30, 7) + family(r, 20, 300)
    texts += [None, "", " \t\n", "one", "One", "one two three four", "a b c d e", "A b c d e"]
    texts += [texts[0]] * 25
    r.shuffle(texts)
    rows = list(enumerate(texts))
    expected = {(i, n, c, c == i) for i, (n, c) in linked(rows).items()}
    assert set(found(spark, rows)) == expected


def test_small_pieces_and_blocks_give_the_same(spark, monkeypatch):
    r = random.Random(6)
    texts = family(r, 120, 40)
    rows = list(enumerate(texts))
    for name, value in (("MEMBERS", 4), ("CANDIDATES", 5), ("BLOCK", 6)):
        monkeypatch.setattr(neardup, name, value)
    expected = {(i, n, c, c == i) for i, (n, c) in linked(rows).items()}
    assert set(found(spark, rows)) == expected


def test_repeated_rows_and_missing_ids(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "A B c d e f"), (None, "a b c d e f"), (7, None)]
    assert sorted(found(spark, rows), key=str) == sorted(
        [(3, 2, 1, False), (3, 2, 1, False), (1, 2, 1, True), (None, 2, None, None), (7, 0, 7, True)],
        key=str,
    )


def test_empty_table(spark):
    assert found(spark, []) == []


def test_sketches_of_a_union_are_the_larger_registers():
    r = np.random.default_rng(1)
    a, b = (np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in (50, 80))
    both = np.unique(np.concatenate([a, b]))
    one, two, union = (neardup.registers(s, np.array([0]))[0] for s in (a, b, both))
    assert (np.maximum(one, two) == union).all()


@pytest.mark.parametrize("similarity", [0.3, 0.75, 0.9])
def test_the_estimate_tells_similarities_apart(similarity):
    r = np.random.default_rng(2)
    kept = 0
    for _ in range(40):
        shared = int(400 * similarity / (1 + similarity) * 2 / 2 * 2)
        values = r.integers(0, 2**63, 1000, dtype=np.uint64)
        a = np.unique(np.concatenate([values[:shared], values[400 : 800 - shared]]))
        b = np.unique(np.concatenate([values[:shared], values[800 : 1200 - shared]]))
        a, b = a[:400], b[:400]
        ra, rb = (neardup.registers(s, np.array([0])) for s in (a, b))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        good = neardup.credible(
            (ra < rb).sum(1), (ra == rb).sum(1), (ra > rb).sum(1), [len(a)], [len(b)]
        )[0]
        assert good or truth < 0.75
        kept += good
    assert kept == 0 if similarity == 0.3 else kept >= 38


def test_long_chains_are_one_component(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in ids}


def test_a_very_long_text(spark):
    text = " ".join(f"w{k % 5_000}" for k in range(300_000))
    rows = [(1, text), (2, text + " end"), (3, "short")]
    assert {(r[0], r[2]) for r in found(spark, rows)} == {(1, 1), (2, 1), (3, 3)}
    assert {r[0]: r[1] for r in found(spark, rows)}[1] == len(shingles(text))
