"""Benchmark decontamination by winnowing.

Of every six consecutive 5-word hashes of a text the least is kept (the last of
equal ones), with its place. Two texts that share ten words in a row have such a
window in common and keep the same hash in it, so joining the kept hashes of
documents and benchmark items finds every pair that shares a span of ten words. Each
pair's hits are then extended to whole shared runs: those of the document's windows that
the item has. Places are never paired with places, so texts of few repeated words cost
no more than others.

Items of fewer than ten words are one window; documents look their windows of
that length up directly. Words are compared by hashes of 64 bits.

The benchmark is split into blocks of bounded size. A few blocks' indexes are sent
to all tasks, and documents go through one step after another until all blocks have
been seen, so no document is shuffled and no task holds more than those blocks,
however large the benchmark is.

Null or wordless texts have no words and no hits; items without item_id or words
are never found; rows of one item_id are one item. Every input row gives one row.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import Words, bytes_where, gram_hashes, map_arrow, stored, text_blocks

#: Words of a window; words of a fingerprint; fingerprints that one is kept of.
WINDOW = 10
GRAM = 5
KEEP = WINDOW - GRAM + 1
#: Bytes of benchmark text in one block, about, and blocks of one step.
BLOCK, BLOCKS_AT_ONCE = 8 << 20, 4

_WORD = bytes_where(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

HITS = "array<struct<start:int,end:int>>"


def winnow(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of the kept hashes: the last least one of each window of ``KEEP``
    within one owner. ``hashes`` may run over several owners."""
    count = len(hashes) - KEEP + 1
    if count <= 0:
        return np.empty(0, np.int64)
    least, place = hashes[:count], np.zeros(count, np.int64)
    for step in range(1, KEEP):
        new = hashes[step : step + count]
        lower = new <= least
        least = np.where(lower, new, least)
        place[lower] = step
    place += np.arange(count)
    return np.unique(place[owner[:count] == owner[KEEP - 1 :]])


class BenchmarkIndex:
    """Fingerprints of the items of one block, and their words."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        words = Words(data, offsets, _WORD)
        self.ids = np.array(ids, np.int64)
        sizes = np.diff(words.first)
        grams, whole = words.grams(GRAM)
        keys, items = [], []
        spans, _ = words.grams(WINDOW)
        self.windows = {}  # sorted hashes of each item's windows
        short = defaultdict(list)
        for item, (first, size) in enumerate(zip(words.first[:-1], sizes, strict=True)):
            if size >= WINDOW:
                own = grams[first : first + size - GRAM + 1]
                kept = np.unique(own[winnow(own, np.zeros(len(own), int))])
                keys.append(kept)
                items.append(np.full(len(kept), item))
                self.windows[item] = np.unique(spans[first : first + size - WINDOW + 1])
            elif size:
                short[int(size)].append((gram_hashes(words.hash[first : first + size], size)[0], item))
        self.keys = np.concatenate([*keys, np.empty(0, np.uint64)])
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = np.concatenate([*items, np.empty(0, int)])[order].astype(np.int64)
        self.short = {}
        for size, pairs in short.items():
            pairs.sort()
            self.short[size] = (
                np.array([p[0] for p in pairs], np.uint64),
                np.array([p[1] for p in pairs], np.int64),
            )

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of document words, as (start, end, item), that hold whole windows."""
        found = [self._short(words, *entry) for entry in self.short.items()]
        grams, whole = words.grams(GRAM)
        if len(grams) and len(self.keys):
            owner = words.text[: len(grams)]
            # A window's last gram must end in the text of its first.
            kept = winnow(grams, np.where(whole, owner, -1 - np.arange(len(grams))))
            found.append(self._extended(words, grams[kept], words.text[kept]))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _joined(self, keys: np.ndarray, hashes: np.ndarray):
        """(place among ``hashes``, place among ``keys``) of equal values."""
        begin = np.searchsorted(keys, hashes, "left")
        inside = np.flatnonzero((begin < len(keys)) & (keys[np.minimum(begin, len(keys) - 1)] == hashes))
        begin = begin[inside]
        runs = np.searchsorted(keys, hashes[inside], "right") - begin
        shift = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        return np.repeat(inside, runs), np.repeat(begin, runs) + shift

    def _short(self, words: Words, size: int, entry):
        keys, items = entry
        grams, whole = words.grams(size)
        place, hit = self._joined(keys, grams)
        good = whole[place]
        start = place[good]
        return start, start + size, items[hit[good]]

    def _extended(self, words: Words, hashes: np.ndarray, texts: np.ndarray):
        """Runs of the windows that texts share with the items they share a hash with."""
        known = self.keys[np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)] == hashes
        text, at = np.unique(np.stack([texts[known].astype(np.uint64), hashes[known]]), axis=1)
        place, hit = self._joined(self.keys, at)
        pairs = np.unique(np.stack([text[place].astype(np.int64), self.item[hit]], 1), axis=0)
        windows, _ = words.grams(WINDOW)
        found = [(np.empty(0, np.int64),) * 3]
        for t, item in pairs.tolist():
            first, last = words.first[t], words.first[t + 1] - WINDOW + 1
            own, theirs = windows[first : max(first, last)], self.windows[item]
            near = np.minimum(np.searchsorted(theirs, own), len(theirs) - 1)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], theirs[near] == own, [0]]).astype(np.int8)))
            start, end = first + edges[::2], first + edges[1::2] + WINDOW - 1
            found.append((start, end, np.full(len(start), item)))
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))


def _lists(owner: np.ndarray, size: int, values: pa.Array) -> pa.ListArray:
    """Lists of the values of each owner; owners are sorted."""
    offsets = np.searchsorted(owner, np.arange(size + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """All values of the lists, and the list each is from."""
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _merged(text: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Runs united where they overlap or touch, within each text."""
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    reach = np.maximum.accumulate(end) if len(end) else end  # places grow over texts
    new = np.ones(len(start), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return text[new], start[new], reach[last] if len(end) else end


def _marker(indexes):
    def mark(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            words = Words(data, offsets, _WORD)
            parts = [index.value.matches(words) for index in indexes]
            start, end = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            ids = np.concatenate([i.value.ids[p[2]] for i, p in zip(indexes, parts, strict=True)])
            text = words.text[start]
            seen = np.stack([text, ids], 1)
            # What the earlier steps have found.
            before, runs = _flat(rows.column("hits"))
            text = np.concatenate([text, before])
            start = np.concatenate([start, runs.field("start").to_numpy() + words.first[before]])
            end = np.concatenate([end, runs.field("end").to_numpy() + words.first[before]])
            before, known = _flat(rows.column("items"))
            seen = np.unique(np.concatenate([seen, np.stack([before, known.to_numpy()], 1)]), axis=0)
            text, start, end = _merged(text, start, end)
            runs = pa.StructArray.from_arrays(
                [
                    pa.array((start - words.first[text]).astype(np.int32)),
                    pa.array((end - words.first[text]).astype(np.int32)),
                ],
                names=["start", "end"],
            )
            new = {
                "n_words": pa.array(np.diff(words.first), pa.int64()),
                "hits": _lists(text, len(rows), runs),
                "items": _lists(seen[:, 0], len(rows), pa.array(seen[:, 1], pa.int64())),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(n, rows.column(k)) for k, n in enumerate(rows.schema.names)],
                names=rows.schema.names,
            )

    return mark


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with ``n_words``, ``hits`` (runs of words inside windows, by
    word number) and ``items`` (the item_ids found). ``documents`` needs a column
    text; its columns of these names are replaced."""
    documents = documents.drop("n_words", "hits", "items")
    spark = documents.sparkSession
    known = benchmark.where("item_id is not null and text is not null")
    items = known.select(F.col("item_id").cast("long"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK + 1
    marked = documents.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(HITS).alias("hits"),
        F.array().cast("array<long>").alias("items"),
    )
    for first in range(0, blocks, BLOCKS_AT_ONCE):
        sent = []
        for block in range(first, min(first + BLOCKS_AT_ONCE, blocks)):
            own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
            rows = items.where(own).collect()
            index = BenchmarkIndex([r[0] for r in rows], [r[1] for r in rows])
            sent.append(spark.sparkContext.broadcast(index))
        if first:  # one step at a time holds its blocks and a worker
            marked = stored(marked, "marked")
        marked = map_arrow(marked, _marker(sent), marked.schema)
    return marked
