"""Hard negatives: rows of another label that score within a window below a positive.

Anchors are scored against all rows, in blocks of anchors of bounded size. A pair is
a packed key (anchor, descending score, side, id) whose bytes sort as its fields do.
``repartitionAndSortWithinPartitions`` brings each anchor's pairs together in that
order, and an iterator reads them once: a positive opens its window of scores, and a
negative goes to every open window that it lies in and that is not full. Nothing but
an anchor's few windows is held.

What is shuffled is reduced beside the vectors first, and nothing is lost by it. A
task's rows beyond its ``positives`` best of an anchor's label cannot be among the
best of all rows. With the positives known, a task's rows beyond its ``negatives``
best within a window cannot be among the window's best. So a task sends at most
``positives * (negatives + 1)`` pairs for an anchor, whatever the label it holds.

Components become whole numbers (times ``scale``, rounded down) and products are
exact; a score that no long can hold raises an error. Rows with a null label, id or
vector, or with a null or non-finite component, take no part. Shorter vectors count
as zero beyond their length. A row is an anchor's own if it has the anchor's id. Equal
rows of one id are one anchor; repeated rows of another id are separate candidates.
No anchors, no positives or no rows give no result.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callpulse.llm.common import map_arrow, ship, stored

#: Anchors of a block and bytes of their vectors, about, at most: what is broadcast.
BLOCK_LINES, BLOCK_BYTES = 8_192, 4 << 20
#: Rows that one task scores, about, and scores that are held at once.
SHARD_ROWS, TILE = 16_384, 1 << 20

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)

# anchor's number, descending score, side (a positive first), id: big-endian, so
# that bytes sort as numbers do; signed numbers are moved to begin at 0.
_KEY = struct.Struct(">IQBQ")
_KEYS = np.dtype([("q", ">u4"), ("score", ">u8"), ("side", "u1"), ("id", ">u8")])
_MOVED = 1 << 63
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def pair_keys(anchor: np.ndarray, score: np.ndarray, negative: bool, row_id: np.ndarray) -> list[bytes]:
    keys = np.empty(len(anchor), _KEYS)
    keys["q"], keys["side"] = anchor, negative
    keys["score"] = np.uint64(_MOST) - score.astype(np.int64).view(np.uint64)
    keys["id"] = row_id.astype(np.int64).view(np.uint64) + np.uint64(_MOVED)
    whole = keys.tobytes()
    return [whole[at : at + _KEY.size] for at in range(0, len(whole), _KEY.size)]


def read_key(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, row_id = _KEY.unpack(key)
    return anchor, _MOST - score, bool(negative), row_id - _MOVED


def usable_rows(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, v): rows that take part, components as doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = [F.col(c).isNotNull() for c in (id_column, vector, label)]
    return vectors.where(functools.reduce(Column.__and__, known) & finite).select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of whole numbers, with zeros after the shorter ones: as doubles, or as
    Python's integers where doubles would not be exact."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        whole = np.floor(flat * scale)
    if np.abs(whole).max(initial=0) >= 2.0**53:
        exact = [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in flat.tolist()]
        whole = np.array(exact, object)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), whole.dtype)
    out[np.arange(width) < sizes[:, None]] = whole
    return out


def _largest(matrix: np.ndarray) -> int:
    return int(np.abs(matrix).max(initial=0))


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products as longs, exactly."""
    bound = _largest(anchors) * _largest(rows) * max(rows.shape[1], 1)
    if bound < 1 << 53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 62:
        return anchors.astype(np.int64) @ rows.astype(np.int64).T
    # astype(int) first: an object array may hold floats.
    whole = [np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (anchors, rows)]
    found = whole[0] @ whole[1].T
    if found.size and not (_LEAST < found.min() and found.max() < _MOST):
        raise OverflowError("an inner product is larger than a long can hold")
    return found.astype(np.int64)


class Best:
    """The ``k`` highest scores of each line, ties to the smaller id, over blocks."""

    def __init__(self, lines: int, k: int):
        self.k = k
        self.score = np.full((lines, k), _LEAST)
        self.id = np.full((lines, k), _MOST)
        self.row = np.full((lines, k), -1)

    def add(self, lines: slice, scores: np.ndarray, ids: np.ndarray, first_row: int) -> None:
        """``scores`` has a column for each id; the least long means: not this one."""
        floor = self.score[lines, -1]
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        line, at = np.nonzero((scores >= floor[:, None]) & (scores > _LEAST))
        if not len(line):
            return
        held_line, place = np.nonzero(self.row[lines] >= 0)
        score = np.concatenate([scores[line, at], self.score[lines][held_line, place]])
        name = np.concatenate([ids[at], self.id[lines][held_line, place]])
        row = np.concatenate([at + first_row, self.row[lines][held_line, place]])
        line = np.concatenate([line, held_line])
        order = np.lexsort((row, name, -score, line))
        rank = np.arange(len(order)) - np.searchsorted(line[order], line[order])
        order, rank = order[rank < self.k], rank[rank < self.k]
        for held, new in ((self.score, score), (self.id, name), (self.row, row)):
            held[line[order] + lines.start, rank] = new[order]


def _batches_scored(batches, block, width: int, scale: int):
    """Tiles of scores: lines of the block, ids, labels, first row, products."""
    seen = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _matrix(batch.column("v"), width, scale)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        labels = np.array(batch.column("label").to_pylist(), object)
        step = max(1, TILE // len(ids))
        for first in range(0, len(block["id"]), step):
            lines = slice(first, min(first + step, len(block["id"])))
            found = products(block["v"][lines], rows)
            other = ids[None, :] != block["id"][lines][:, None]
            same = labels[None, :] == block["label"][lines][:, None]
            yield lines, ids, seen, found, other & same, other & ~same
        seen += len(ids)


def _positives(sent, width: int, scale: int, k: int):
    def run(batches):
        block = sent.value
        best = Best(len(block["id"]), k)
        for lines, ids, seen, found, same, _ in _batches_scored(batches, block, width, scale):
            best.add(lines, np.where(same, found, _LEAST), ids, seen)
        line, place = np.nonzero(best.row >= 0)
        columns = {"q": line.astype(np.int32), "score": best.score[line, place], "id": best.id[line, place]}
        yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})

    return run


def _negatives(sent, width: int, scale: int, k: int, low: int, high: int):
    def run(batches):
        block = sent.value
        windows = block["positive"]  # scores, a column for each rank, the least long for none
        best = [Best(len(block["id"]), k) for _ in range(windows.shape[1])]
        # Whole percentages of longs may not fit a long: bounds by Python's integers.
        bounds = [
            [(-(-low * p // 100), high * p // 100) if p > _LEAST else (1, 0) for p in column]
            for column in windows.T.tolist()
        ]
        bounds = [np.clip(np.array(b, object), _LEAST + 1, _MOST).astype(np.int64) for b in bounds]
        for lines, ids, seen, found, _, different in _batches_scored(batches, block, width, scale):
            for held, bound in zip(best, bounds):
                inside = (found >= bound[lines, :1]) & (found <= bound[lines, 1:]) & different
                held.add(lines, np.where(inside, found, _LEAST), ids, seen)
        # A row that several windows want is one pair.
        places = [np.nonzero(held.row >= 0) for held in best]
        line = np.concatenate([at[0] for at in places])
        score, name, row = (
            np.concatenate([getattr(held, c)[at] for held, at in zip(best, places)])
            for c in ("score", "id", "row")
        )
        _, once = np.unique(np.stack([line, row]), axis=1, return_index=True)
        keys = pair_keys(line[once], score[once], True, name[once])
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary())})

    return run


def mined(keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int):
    """(anchor's number, positive, rank, negative, their scores) from sorted keys.

    At equal scores positives come first, so a window is open before the first
    negative that it takes: at most its own positive's score.
    """
    anchor, windows = None, []
    for key in keys:
        q, score, negative, row_id = read_key(key)
        if q != anchor:
            anchor, windows = q, []
        if not negative:
            if len(windows) < positives:
                windows.append([score, row_id, 0])
            continue
        for window in windows:
            at, positive_id, taken = window
            if taken < negatives and low * at <= 100 * score <= high * at:
                window[2] += 1
                yield q, positive_id, taken + 1, row_id, at, score


def _anchor_number(key: bytes) -> int:
    return int.from_bytes(key[:4], "big")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of another label whose score is ``low`` to ``high`` per
    cent of the positive's: see ``RESULT``. Higher scores come first, ties by id.

    ``is_anchor`` is a condition on the column ``id``; ``high`` is 100 at most. A
    positive of negative score has no window, and one of score 0 a window of 0.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError(f"a window lies below its positive: {low} to {high} per cent")
    spark = vectors.sparkSession
    ship(spark)
    usable = usable_rows(vectors, id_column, vector, label)
    # Dealt in turn: neither a label, an id nor a repeated vector gathers in one shard.
    count, width = usable.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rows = stored(usable.repartition(max(1, -(-count // SHARD_ROWS))), "mined-vectors")
    anchors = stored(rows.where(is_anchor).distinct(), "mined-anchors")
    lines = min(BLOCK_LINES, max(1, BLOCK_BYTES // (8 * max(width, 1))))
    blocks = max(1, -(-anchors.count() // lines))
    options = {"positives": positives, "negatives": negatives, "low": low, "high": high}
    results = []
    for number in range(blocks):
        block = anchors.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)) == number)
        found = block.orderBy("id", "label", "v").toArrow().combine_chunks()
        if not found.num_rows:
            continue
        held = {
            "id": found["id"].to_numpy(),
            "label": np.array(found["label"].to_pylist(), object),
            "v": _matrix(found["v"].combine_chunks(), width, scale),
            "positive": np.full((found.num_rows, positives), _LEAST),
        }
        results.append(_mine_block(rows, held, width, scale, **options))
    if not results:
        return spark.createDataFrame([], RESULT)
    return functools.reduce(DataFrame.union, results)


def _mine_block(rows, held, width, scale, positives, negatives, low, high) -> DataFrame:
    """The result for one block of anchors, stored."""
    spark = rows.sparkSession
    context = spark.sparkContext
    pair = "q int, score long, id long"
    send = context.broadcast(held)
    own = map_arrow(rows, _positives(send, width, scale, positives), pair)
    best_first = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = own.withColumn("place", F.row_number().over(best_first) - 1)
    best = ranked.where(F.col("place") < positives).toArrow()
    held = held | {"positive": held["positive"].copy()}
    q, place, score, row_id = (best[c].to_numpy() for c in ("q", "place", "score", "id"))
    held["positive"][q, place] = score
    send = context.broadcast(held)
    rest = map_arrow(rows, _negatives(send, width, scale, negatives, low, high), "key binary")
    opening = context.parallelize(pair_keys(q, score, False, row_id), 1)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    pairs = opening.union(rest.rdd.map(lambda row: bytes(row[0]))).map(lambda key: (key, None))
    ordered = pairs.repartitionAndSortWithinPartitions(tasks, _anchor_number)
    names = context.broadcast(held["id"])

    def emit(group):
        for q, *found in mined((key for key, _ in group), positives, negatives, low, high):
            yield (int(names.value[q]), *found)

    found = ordered.mapPartitions(emit)
    return stored(spark.createDataFrame(found, StructType.fromDDL(RESULT), verifySchema=False), "mined")
