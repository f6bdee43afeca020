"""Best-fit decreasing packing of tokenized documents into fixed-length sequences.

Documents become ids and an end id; longer ones than a sequence are cut, the
first piece taking the remainder. Pieces of one length are alike to the packer, so
it packs counts: for lengths from the longest down, a segment tree over remaining
capacities finds the tightest open bins in logarithmic time, and all bins of that
capacity are filled together. This is best-fit decreasing, piece for piece, and
its plan is a short list of moves whose size depends on the number of different
lengths and not on the number of documents. Only the histogram of lengths
reaches the driver.

Pieces are numbered within their length in parallel (lengths are salted, counts
per salt added up) and read their sequence and place off the plan.

Null texts are empty ones: a piece of one id. Every input row gives its pieces,
repeated rows as well; doc_id may be null.
"""

from __future__ import annotations

import base64
import functools
import json
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.llm.common import give_back, map_arrow, stored

SEQUENCE = 1024
END_ID = 2
#: Pieces of one salt, about, and the least number of salts.
SALT_ROWS = 1_000_000
LEAST_SALTS = 128

PIECES = "doc_id long, piece int, start long, length long, ids binary"


@functools.cache
def encoding(ranks_path: str):
    """The vocabulary as a byte-pair encoder, with the added tokens of the JSON beside
    the rank file.

    Where all added tokens are allowed, it gives the ids of the library
    ``tokenizers`` on that JSON at a quarter of its time (the tests compare them).
    """
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(rank) for t, rank in map(bytes.split, lines)}
    with open(os.path.splitext(ranks_path)[0] + ".json", encoding="utf-8") as vocabulary:
        added = {t["content"]: t["id"] for t in json.load(vocabulary)["added_tokens"]}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


@functools.cache
def encoder(ranks_path: str):
    """A function from a text to its ids: those of ``tokenizers`` on the JSON.

    The byte-pair encoder splits words by a backtracking pattern, which gives up on runs
    of some hundred thousand blanks. Such a text is encoded by ``tokenizers`` itself.
    """
    fast = encoding(ranks_path)

    @functools.cache
    def plain():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(os.path.splitext(ranks_path)[0] + ".json")

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(plain().encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def tokenized(
    documents: DataFrame,
    ranks_path: str | None = None,
    length: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """A row per piece: doc_id, piece (from 0), start (ids before it), length, ids
    (little-endian unsigned 32-bit numbers)."""
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches):
        encode = encoder(path)
        for rows in batches:
            at, piece, start, size, ids = [], [], [], [], []

            def flush():
                return pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

            held = 0
            for k, text in enumerate(rows.column("text")):
                own = np.append(encode(text.as_py() or ""), end_id)
                own = own.astype("<u4")
                cuts = [0, *range(len(own) % length or length, len(own) + 1, length)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(k)
                    piece.append(p)
                    start.append(a)
                    size.append(b - a)
                    ids.append(own[a:b].tobytes())
                held += 4 * len(own)
                if held > 16 << 20:
                    yield flush()
                    at, piece, start, size, ids, held = [], [], [], [], [], 0
            if at:
                yield flush()
            at, piece, start, size, ids = [], [], [], [], []
            give_back()

    source = documents.select(F.col("doc_id").cast("long"), "text")
    return map_arrow(source, run, PIECES)


class CapacityTree:
    """How many bins are open at each remaining capacity; finds the tightest."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, bins: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += bins
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The least capacity of an open bin that is ``least`` or more."""
        node = least + self.size
        if self.count[node]:
            return least
        while node > 1 and (node % 2 or not self.count[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size


def plan(counts: dict[int, int], capacity: int = SEQUENCE) -> np.ndarray:
    """The moves of best-fit decreasing over ``counts`` pieces of each length.

    A move (length, rank, bin, bins, each, offset) puts the pieces of that length
    from that rank on into consecutive bins, ``each`` into every bin, one after
    another from ``offset``. Sorted by length, then rank.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    moves, bins = [], 0

    def keep(first: int, number: int, left: int) -> None:
        if number and left:
            open_bins.setdefault(left, []).append((first, number))
            tree.add(left, number)

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = tree.tightest(length)
            if left is None:
                left, first = capacity, bins
                number = -(-rest // (capacity // length))
                bins += number
            else:
                first, number = open_bins[left].pop()
                tree.add(left, -number)
            each = left // length
            full = min(number, rest // each)
            if full:
                moves.append((length, rank, first, full, each, capacity - left))
                keep(first, full, left - each * length)
                rank, rest = rank + full * each, rest - full * each
            if full < number and rest:  # fewer than ``each`` are left, for one bin
                moves.append((length, rank, first + full, 1, rest, capacity - left))
                keep(first + full, 1, left - rest * length)
                full, rest = full + 1, 0
            keep(first + full, number - full, left)
    return np.array(sorted(moves), np.int64).reshape(-1, 6)


def _placed(rows: pa.RecordBatch, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces with ``length`` and ``rank``."""
    length, rank = (rows.column(c).to_numpy() for c in ("length", "rank"))
    room = np.int64(1) << 44
    move = np.searchsorted(moves[:, 0] * room + moves[:, 1], length * room + rank, "right") - 1
    _, first_rank, first_bin, _, each, offset = moves[move].T
    nth = rank - first_rank
    return first_bin + nth // each, offset + nth % each * length


def pack(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """The pieces, all their columns, with ``sequence_id`` and ``offset``.

    ``pieces`` has a column length, from 1 to ``capacity``. It is stored first: the
    numbering must see the same rows as the counting. Columns named as the results
    are replaced.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces.drop("sequence_id", "offset"), "pieces")
    names = pieces.columns
    lengths = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    moves = spark.sparkContext.broadcast(plan(lengths, capacity))
    salts = max(LEAST_SALTS, sum(lengths.values()) // SALT_ROWS)
    columns = [F.col(f"`{name}`") for name in names]
    salted = pieces.select(
        F.struct(*columns).alias("row"),
        F.col("length"),
        F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int").alias("salt"),
    )
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row"))
    ranked = (
        salted.withColumn("nth", nth)
        .join(base, ["length", "salt"])
        .select("row", "length", (F.col("base") + F.col("nth") - 1).alias("rank"))
    )
    schema = ranked.select(
        "row", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    ).schema

    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            sequence, offset = _placed(rows, moves.value)
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array(sequence), pa.array(offset)],
                names=["row", "sequence_id", "offset"],
            )

    return map_arrow(ranked, run, schema).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The filled sequences: sequence_id, ids (binary as in the pieces), doc_ids and
    offsets of the pieces in order. A group is one sequence, so it is bounded."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda all, one: F.concat(all, one["ids"])).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.offset").alias("offsets"),
    )
