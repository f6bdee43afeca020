import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callpulse.llm import hard_negatives as hn


def brute(rows, every=10, positives=3, negatives=4, low=30, high=90):
    usable = [
        (i, label, [int(np.floor(256 * float(x))) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, label, a in {(i, label, tuple(v)) for i, label, v in usable if i % every == 0}:
        scored = [(-sum(x * y for x, y in zip(a, v)), j, own) for j, own, v in usable if j != i]
        own = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        rest = sorted((s, j) for s, j, other in scored if other != label)
        for p, j in own:
            near = [(s, k) for s, k in rest if low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, rank + 1, k, -p, -s) for rank, (s, k) in enumerate(near)]
    return sorted(out)


def found(spark, rows, kind="float"):
    wide = [(i, label, v, "e", -1) for i, label, v in rows]
    df = spark.createDataFrame(wide, f"vec_id long, label int, embedding array<{kind}>, id string, v int")
    return sorted(map(tuple, hn.hard_negatives(df, F.col("id") % 10 == 0, 3, 4).collect()))


ODD = [
    (701, 1, None), (702, 1, [None, 1.0, 2.0]), (703, 1, [float("nan"), 1.0, 1.0]),
    (704, 1, [float("inf"), 1.0, 1.0]), (705, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]),
    (800, 2, [1.0, 1.0]), (800, 2, [1.0, 1.0]), (5, 0, [1.0, 1.0, 1.0]), (900, 1, []), (910, 3, [2.0]),
    (-20, 1, [1.0, 0.5, 0.0]), (920, 0, [-1.5, -1.5, -1.5]),
]


@pytest.mark.parametrize("shard, lines, tile", [(16_384, 8_192, 1 << 20), (50, 7, 90)])
def test_results_are_those_of_all_pairs(spark, monkeypatch, shard, lines, tile):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_LINES", lines), ("TILE", tile)):
        monkeypatch.setattr(hn, name, value)
    r = random.Random(1)
    values = [-1.5, 0.0, 0.25, 0.5, 1.0]
    rows = [(i, r.randrange(4), [r.choice(values) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, 1, [1.5, 1.5, 1.5]) for i in range(120)]  # one common vector and label
    rows += [(2001, 2, [0.75, 0.75, 0.75])] * 20 + [(2002, 1, [1.5, 1.5, 1.0])] * 3  # repeated rows
    expected = brute(rows + ODD)
    assert any(p == 0 for *_, p, _ in expected)  # windows of score 0, whose negatives tie with it
    assert found(spark, rows + ODD) == expected


@pytest.mark.parametrize("span", [1e6, 3e6])
def test_large_numbers_stay_exact(spark, span):
    r = random.Random(2)
    rows = [(i, r.randrange(2), [r.uniform(-span, span) for _ in range(4)]) for i in range(60)]
    assert found(spark, rows, "double") == brute(rows)


def test_products_of_any_size_are_exact_or_raise():
    big = np.array([[2**61, -(2**61)]], object)
    assert hn.products(big, np.array([[3, 1], [1, 3]], object)).tolist() == [[2**62, -(2**62)]]
    with pytest.raises(OverflowError):
        hn.products(big, big)


@pytest.mark.parametrize(
    "rows",
    [[], [(10, 1, [1.0])], [(10, 1, [1.0]), (11, 1, None)], [(1, 1, [1.0]), (2, 2, [2.0])], [(10, 1, [1.0]), (11, 1, [1.0])]],
)
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_keys_sort_as_their_fields():
    pairs = list(itertools.product((0, 7, 1 << 20), (hn._MOST - 1, 5, 0, -5, hn._LEAST + 1), (False, True), (-(1 << 63), -1, 0, 9)))
    keys = [
        hn.pair_keys(np.array([q]), np.array([s]), side, np.array([i]))[0] for q, s, side, i in pairs
    ]
    assert [hn.read_key(k) for k in keys] == pairs
    order = sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))
    assert [hn.read_key(k) for k in sorted(keys)] == order
