"""Exact inner-product search: a ball tree per shard, branch and bound.

Vectors are whole numbers (each component times 1024, rounded down). A shard is
one partition of bounded size; its rows form a ball tree whose nodes bound every
inner product with a query q by q.c + |q| r, for centre c and radius r. Queries
come in blocks. First each shard scores every query against its most promising
leaf; the k-th best of those scores over all shards is a score the result cannot
be below. Then each shard descends from the root, nodes of higher bounds first,
leaving out what lies below the current k-th score, which starts at that shared
one and rises with what the shard finds. Equal bounds are never left out, so ties
go to the smaller vec_id.

Rows are dealt to shards in turn and stored so, once for all blocks. Products are exact;
where the components are so large that one might not fit a long, the search raises.

Vectors that are null or hold null or non-finite components take no part, nor do
rows without vec_id. Shorter vectors count as zero beyond their length. A row is a
query's own if it has the query's vec_id; repeated rows of another id are separate
candidates, and equal rows of one id are one query.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpulse.llm.common import map_arrow, stored

SCALE = 1024
#: Rows of a shard and queries of a block, about, at most; rows of a leaf.
SHARD_ROWS, BLOCK, LEAF = 16_384, 4_096, 64
#: Queries that descend together.
TOGETHER = 256


def whole_numbers(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v): usable vectors as whole numbers."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(id_column).cast("long").alias("id"), scaled.alias("v")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists as rows of one matrix, with zeros after the shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, int)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


@dataclass
class BallTree:
    """Nodes in arrays: children (or -1), rows, centre, radius."""

    ids: np.ndarray
    rows: np.ndarray
    exact: type

    def __post_init__(self):
        self.x = self.rows.astype(np.float64)
        self.left, self.right, self.span, centre, radius = [], [], [], [], []
        order = np.arange(len(self.ids))

        def build(first: int, last: int) -> int:
            node = len(self.left)
            own = self.x[order[first:last]]
            middle = own.mean(0)
            self.left.append(-1)
            self.right.append(-1)
            self.span.append((first, last))
            centre.append(middle)
            radius.append(np.sqrt(((own - middle) ** 2).sum(1).max()))
            if last - first > LEAF:
                axis = np.argmax(own.max(0) - own.min(0)) if own.shape[1] else 0
                half = (last - first) // 2
                if own.shape[1]:
                    part = np.argpartition(own[:, axis], half)
                    order[first:last] = order[first:last][part]
                self.left[node] = build(first, first + half)
                self.right[node] = build(first + half, last)
            return node

        if len(order):
            build(0, len(order))
        self.ids, self.x = self.ids[order], self.x[order]
        self.rows = self.x if self.exact is np.float64 else self.rows[order]
        self.centre = np.array(centre).reshape(len(centre), -1)
        self.radius = np.array(radius)
        self.far = np.sqrt((self.centre**2).sum(1))
        self.children = np.array([self.left, self.right]).T.reshape(-1, 2)

    def bounds(self, queries: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """At least every inner product in the node; a little more for rounding."""
        top = queries @ self.centre[nodes].T + norms[:, None] * self.radius[nodes]
        return top + 1 + 1e-12 * norms[:, None] * (self.far[nodes] + self.radius[nodes])

    def search(self, ids, queries, floor, k, promising_only=False):
        """(query, vec_id, score) of the ``k`` best rows of each query that reach its
        floor. ``promising_only``: only from the leaf of the highest bound."""
        near = queries.astype(np.float64)
        norms = np.sqrt((near**2).sum(1))
        typed = near if self.exact is np.float64 else queries
        best = np.full((len(ids), k), np.iinfo(np.int64).min)
        owner = np.full((len(ids), k), np.iinfo(np.int64).max)
        floor = floor.copy()

        def score(leaf: int, active: np.ndarray) -> None:
            first, last = self.span[leaf]
            found = typed[active] @ self.rows[first:last].T
            if found.dtype != np.int64:
                found = np.rint(found).astype(np.int64)
            names = np.broadcast_to(self.ids[first:last], found.shape)
            found = np.where(names == ids[active][:, None], np.iinfo(np.int64).min, found)
            hopeful = (found >= floor[active][:, None]).any(1)
            active, found, names = active[hopeful], found[hopeful], names[hopeful]
            if not len(active):
                return
            scores = np.concatenate([best[active], found], 1)
            names = np.concatenate([owner[active], names], 1)
            order = np.lexsort((names, -np.maximum(scores, -np.iinfo(np.int64).max)), axis=1)[:, :k]
            best[active] = np.take_along_axis(scores, order, 1)
            owner[active] = np.take_along_axis(names, order, 1)
            floor[active] = np.maximum(floor[active], best[active, -1])

        everyone = np.arange(len(ids))
        leaf_nodes = np.flatnonzero(self.children[:, 0] < 0)
        first_leaf = leaf_nodes[self.bounds(near, norms, leaf_nodes).argmax(1)]
        for leaf in np.unique(first_leaf):
            score(leaf, everyone[first_leaf == leaf])
        # Level by level, with the queries that may still gain below each node.
        level = [] if promising_only else [(0, everyone)]
        while level:
            nodes = np.array([n for n, _ in level])
            bound = self.bounds(near, norms, nodes)
            deeper = []
            for at in np.argsort(-bound.max(0), kind="stable"):
                node, active = level[at]
                active = active[bound[active, at] >= floor[active]]
                if not len(active):
                    continue
                if self.children[node, 0] < 0:
                    rest = active[first_leaf[active] != node]
                    if len(rest):
                        score(node, rest)
                else:
                    deeper += [(child, active) for child in self.children[node]]
            level = deeper
        seen = best > np.iinfo(np.int64).min
        return np.nonzero(seen)[0], owner[seen], best[seen]


RESULT = "q int, query_id long, vec_id long, score long"


def _shards(batches):
    """The rows in tables of about ``SHARD_ROWS``."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SHARD_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _searcher(sent, width: int, k: int, promising_only: bool):
    def run(batches):
        block = sent.value
        for shard in _shards(batches):
            rows = _matrix(shard["v"], width)
            sizes = [float(np.abs(v).max(initial=0)) for v in (rows, block["v"])]
            largest = sizes[0] * sizes[1] * max(width, 1)
            tree = BallTree(shard["id"].to_numpy(), rows, np.float64 if largest < 2**52 else np.int64)
            for first in range(0, len(block["id"]), TOGETHER):
                part = slice(first, first + TOGETHER)
                place, names, scores = tree.search(
                    block["id"][part], block["v"][part], block["floor"][part], k, promising_only
                )
                q = place + first
                yield pa.RecordBatch.from_pydict(
                    {
                        "q": pa.array(q, pa.int32()),
                        "query_id": pa.array(block["id"][q]),
                        "vec_id": pa.array(names),
                        "score": pa.array(scores),
                    }
                )

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of highest inner product with each query: query_id, rank from 1,
    vec_id, score. ``is_query`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    usable = whole_numbers(vectors, id_column, vector)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    size = [F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))]
    count, width, most = usable.agg(*size).first()
    if (most + 1) ** 2 * width >= 2.0**63:
        raise OverflowError("an inner product may be larger than a long can hold")
    rows = shards = stored(usable.repartition(max(1, -(-count // SHARD_ROWS))), "vectors")
    queries = rows.where(is_query).distinct()
    blocks = max(1, -(-queries.count() // BLOCK))
    parts = []
    for number in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)) == number)
        found = block.orderBy("id", "v").toArrow()
        held = {
            "id": found["id"].to_numpy().astype(np.int64),
            "v": _matrix(found["v"], width),
            "floor": np.full(found.num_rows, np.iinfo(np.int64).min),
        }
        search = functools.partial(_searcher, width=width, k=k)
        first = map_arrow(shards, search(spark.sparkContext.broadcast(held), promising_only=True), RESULT)
        # The k-th best of what the promising leaves of all shards hold.
        place = Window.partitionBy("q").orderBy(F.desc("score"))
        floors = (
            first.withColumn("n", F.row_number().over(place)).where(F.col("n") == k).select("q", "score").toArrow()
        )
        held["floor"] = held["floor"].copy()
        held["floor"][floors["q"].to_numpy()] = floors["score"].to_numpy()
        full = map_arrow(shards, search(spark.sparkContext.broadcast(held), promising_only=False), RESULT)
        parts.append(stored(full.withColumn("block", F.lit(number)), "found"))
    ranked = Window.partitionBy("block", "q").orderBy(F.desc("score"), "vec_id")
    return (
        functools.reduce(DataFrame.union, parts)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
