import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callpulse.llm import topk


def brute(rows, every=10, k=5):
    usable = [
        (i, [int(np.floor(1024 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, q in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return sorted(out)


def found(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, "e") for i, v in rows], f"vec_id long, embedding array<{kind}>, id string")
    return sorted(map(tuple, topk.top_k(df, F.col("id") % 10 == 0, 5).collect()))


ODD = [
    (701, None), (702, [None, 1.0, 2.0]), (703, [float("nan"), 1.0, 1.0]), (704, [float("inf"), 1.0, 1.0]),
    (None, [1.0, 1.0, 1.0]), (800, [1.0, 1.0]), (800, [1.0, 1.0]), (5, [1.0, 1.0, 1.0]), (900, []),
]


@pytest.mark.parametrize("shard, block, together", [(16_384, 4_096, 256), (50, 7, 3)])
def test_results_are_those_of_all_products(spark, monkeypatch, shard, block, together):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK", block), ("TOGETHER", together), ("LEAF", 8)):
        monkeypatch.setattr(topk, name, value)
    r = random.Random(1)
    rows = [(i, [r.choice([-1.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, [1.5, 1.5, 1.5]) for i in range(100)]  # one very common vector
    assert found(spark, rows + ODD) == brute(rows + ODD)


def test_large_numbers_stay_exact(spark):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1e6, 1e6) for _ in range(4)]) for i in range(60)]
    assert found(spark, rows, "double") == brute(rows)


@pytest.mark.parametrize("large", [1e18, 3e6, -1e300])
def test_products_beyond_a_long_raise(spark, large):
    with pytest.raises(OverflowError):
        found(spark, [(10, [large, large]), (11, [large, large])], "double")


@pytest.mark.parametrize("rows", [[], [(10, [1.0])], [(10, [1.0]), (11, None)], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_bounds_hold_and_leaves_are_left_out():
    r = np.random.default_rng(0)
    centres = r.integers(-2000, 2000, (40, 8))
    rows = (centres[:, None] + r.integers(-20, 20, (40, 50, 8))).reshape(-1, 8)
    tree = topk.BallTree(np.arange(len(rows)), rows, np.float64)
    queries = rows[::200].astype(float)
    norms = np.sqrt((queries**2).sum(1))
    bound = tree.bounds(queries, norms, np.arange(len(tree.span)))
    for node, (a, b) in enumerate(tree.span):
        assert (queries @ tree.x[a:b].T <= bound[:, [node]]).all()
    scored = []
    tree.rows = type("Counted", (), {"__getitem__": lambda self, s: scored.append(s) or tree.x[s]})()
    tree.search(np.arange(0, len(rows), 200), rows[::200], np.full(len(queries), np.iinfo(np.int64).min), 5)
    assert len(scored) < len(queries) * sum(c < 0 for c in tree.left) / 4
