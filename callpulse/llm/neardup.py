"""Near duplicates: SetSketch registers in bands, a joint estimate, exact checks.

A text's set is its distinct shingles of five words. Register i of its sketch is
floor(1 - log_b h), where h is the least of the shingles' exponential variables
under hash i: registers of a union are the larger of the parts', and those of two
sets are equal about as often as their Jaccard similarity says.

1. *Sketch* every text; equal sets form a class, represented by its least doc_id.
2. *Band*: classes that agree in all registers of a band share a bucket. Each
   bucket's classes are paired with one of them, not with each other.
3. *Estimate*: the similarity of a pair is the likeliest one given how many
   registers are less, equal and greater and both set sizes. Pairs whose
   estimate makes the threshold incredible go.
4. *Verify* on full sets, and join what is linked to components.
5. *Rest*: where a bucket still holds several components, every pair across two
   of them is estimated, in blocks, and those left are verified, one member
   against all of the other component in chunks. No link that a band shows is
   lost, and inside a component no pair is looked at twice.

A pair at exactly the threshold shares no band once in a million times.

Rows with null or wordless text have an empty set and no links. Rows of one
doc_id are one document to its links; rows without doc_id get null results.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import (
    Words,
    bloom_filter,
    bytes_where,
    map_arrow,
    may_contain,
    mix,
    stored,
    text_blocks,
)
from callpulse.llm.components import components

BANDS, ROWS = 36, 4
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
SHINGLE = 5
#: Similarity from which two sets are linked, in hundredths.
PERCENT = 75
#: Twice the log likelihood a pair may lack: five standard deviations.
SLACK = 25.0
#: Members and candidates of one piece of verification; one block of a bucket.
MEMBERS, CANDIDATES, BLOCK = 128, 512, 1024

_WORD = bytes_where(lambda b: b != 32 and not 9 <= b <= 13)
_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
_TIMES, _PLUS = _SEEDS[:REGISTERS] | np.uint64(1), _SEEDS[REGISTERS:]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(data, offsets, _WORD)
    grams, whole = words.grams(SHINGLE)
    sets = []
    for first, last in zip(words.first[:-1], words.first[1:], strict=True):
        if last - first >= SHINGLE:
            sets.append(np.unique(grams[first : last - SHINGLE + 1]))
        elif last > first:
            total = np.array([last - first], np.uint64)
            for value in words.hash[first:last]:
                total = mix(total * np.uint64(31) + value)
            sets.append(total)
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set; equal for equal sets only, but for 2 ** -128."""
    one, two = mix(values + np.uint64(1)), mix(values ^ np.uint64(0x5851F42D4C957F2D))
    return np.add.reduceat(one, starts).view(np.int64), np.add.reduceat(two, starts).view(np.int64)


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of registers for each non-empty set."""
    least = np.empty((REGISTERS, len(starts)), np.uint64)
    for i in range(REGISTERS):
        least[i] = np.minimum.reduceat(values * _TIMES[i] + _PLUS[i], starts)
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0**64
    height = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(height) / np.log(BASE)), 0, 65535).astype(np.uint16)


SKETCH = "doc_id long, n_shingles long, one long, two long, bands array<long>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_blocks(batches, "text"):
        sets = shingle_sets(data, offsets)
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        one, two = np.zeros((2, len(sets)), np.int64)
        bands = np.zeros((0, BANDS), np.int64)
        if len(full):
            values = np.concatenate(sets)
            starts = (np.cumsum(sizes) - sizes)[full]
            one[full], two[full] = _digests(values, starts)
            bands = np.ascontiguousarray(registers(values, starts)).view(np.int64)
        ends = np.cumsum(np.where(sizes > 0, BANDS, 0), dtype=np.int32)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        lists = pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one), pa.array(two), lists],
            names=["doc_id", "n_shingles", "one", "two", "bands"],
        )


def sketches(documents: DataFrame) -> DataFrame:
    return map_arrow(documents.select(F.col("doc_id").cast("long"), "text"), _sketch, SKETCH)


# Estimate


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def _likelihood(less, same, more, u, v, similarity):
    p_more = _share(u - v * similarity)
    p_less = _share(v - u * similarity)
    p_same = np.maximum(1 - p_more - p_less, 1e-300)
    return (
        more * np.log(np.maximum(p_more, 1e-300))
        + less * np.log(np.maximum(p_less, 1e-300))
        + same * np.log(p_same)
    )


_GRID = np.linspace(0, 1, 65)


def credible(less, same, more, size_a, size_b) -> np.ndarray:
    """Whether the threshold is credible, given the registers of two sets that are
    less, equal and greater. Sizes that exclude it do so for sure."""
    less, same, more = (np.asarray(x, float)[:, None] for x in (less, same, more))
    a, b = np.asarray(size_a, float)[:, None], np.asarray(size_b, float)[:, None]
    u, v = a / (a + b), b / (a + b)
    most = np.minimum(a / b, b / a)
    grid = _likelihood(less, same, more, u, v, most * _GRID)
    best = grid.argmax(1)
    threshold = np.minimum(PERCENT / 100, most)
    there = _likelihood(less, same, more, u, v, threshold)[:, 0]
    estimate = most[:, 0] * _GRID[best]
    near = 2 * (grid.max(1) - there) <= SLACK
    return (100 * most[:, 0] >= PERCENT - 1e-9) & ((estimate >= PERCENT / 100) | near)


def _as_registers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.int64).view(np.uint16).reshape(-1, REGISTERS)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        if not rows.num_rows:
            continue
        a, b = (_as_registers(rows.column(c)) for c in ("a_bands", "b_bands"))
        good = credible(
            (a < b).sum(1), (a == b).sum(1), (a > b).sum(1),
            rows.column("a_size").to_numpy(), rows.column("b_size").to_numpy(),
        )
        yield pa.RecordBatch.from_arrays(
            [rows.column(c).filter(pa.array(good)) for c in ("x", "target")], names=["x", "target"]
        )


# Verify


class _Members:
    """Full sets of some members; counts what a set shares with each of them."""

    def __init__(self):
        self.ids, self.sets, self.index = [], [], None

    def add(self, doc_id: int, values: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sets.append(values)

    def linked(self, values: np.ndarray) -> list[int]:
        if self.index is None:
            sizes = np.array([len(s) for s in self.sets], np.int64)
            flat = np.concatenate([*self.sets, np.empty(0, np.uint64)])
            order = np.argsort(flat, kind="stable")
            self.index = flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes
        flat, owner, sizes = self.index
        begin, end = np.searchsorted(flat, values, "left"), np.searchsorted(flat, values, "right")
        runs = end - begin
        places = np.repeat(begin - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        shared = np.bincount(owner[places], minlength=len(sizes))
        union = sizes + len(values) - shared
        good = np.flatnonzero((100 * shared >= PERCENT * union) & (shared > 0))
        return [self.ids[k] for k in good]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece, members before candidates: links that full sets show.

    Of the links from one candidate to one connected target, one says it all.
    """
    members, found = _Members(), ([], [])

    def flush():
        a, b = (pa.array(side, pa.int64()) for side in found)
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    last = None
    for rows, data, offsets in text_blocks(batches, "text"):
        keys = list(zip(*(rows.column(k).to_pylist() for k in ("target", "chunk", "part")), strict=True))
        wanted = rows.column("candidate").to_pylist()
        ids, ones = rows.column("id").to_pylist(), rows.column("one").to_pylist()
        sets = shingle_sets(data, offsets)
        full = [k for k, s in enumerate(sets) if len(s)]
        digests = {}
        if full:
            sizes = np.array([len(sets[k]) for k in full])
            one, _ = _digests(np.concatenate([sets[k] for k in full]), np.cumsum(sizes) - sizes)
            digests = dict(zip(full, one.tolist(), strict=True))
        for k, key in enumerate(keys):
            if key != last:
                members, last = _Members(), key
            if digests.get(k) != ones[k]:  # another text of a repeated doc_id
                continue
            if not wanted[k]:
                members.add(ids[k], sets[k])
                continue
            for other in members.linked(sets[k])[:1]:
                found[0].append(ids[k])
                found[1].append(other)
        if len(found[0]) >= 10_000:
            yield flush()
            found = ([], [])
    yield flush()


def verified(candidates: DataFrame, membership: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) from candidate ``x`` to a member of its ``target`` component.

    ``membership``: (id, component, size). A component is cut into chunks and its
    candidates into parts, so that a hot one becomes many pieces of bounded size.
    ``texts``: (id, one, text) of all that occur.
    """
    weight = F.count("*").alias("candidates")
    targets = candidates.groupBy("target").agg(weight).select(
        F.col("target"), F.ceil(F.col("candidates") / CANDIDATES).cast("int").alias("parts")
    )
    sized = membership.groupBy(F.col("component").alias("target")).agg(
        F.ceil(F.count("*") / MEMBERS).cast("int").alias("chunks")
    )
    targets = targets.join(sized, "target")
    # Each piece's members, once for each part of the candidates.
    ours = (
        membership.select("id", F.col("component").alias("target"))
        .join(targets, "target")
        .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(3)), F.col("chunks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("target", "chunk", "part", F.lit(False).alias("candidate"), "id")
    )
    theirs = (
        candidates.join(targets, "target")
        .withColumn("part", F.pmod(F.xxhash64("x", F.lit(5)), F.col("parts")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("target", "chunk", "part", F.lit(True).alias("candidate"), F.col("x").alias("id"))
    )
    pieces = ours.union(theirs).join(texts, "id")
    keys = ["target", "chunk", "part"]
    dealt = pieces.repartition(*keys).sortWithinPartitions(*keys, "candidate")
    return map_arrow(dealt, _verify, "a long, b long")


# Rest


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket block, its fixed side first: credible pairs across
    components, as (x, target), the larger component being the target."""
    held: list[tuple] = []
    found: set[tuple[int, int]] = set()

    def compare(band, left, right):
        for lo in range(0, len(right["id"]), 256):
            part = {k: v[lo : lo + 256] for k, v in right.items()}
            other = left["component"][:, None] != part["component"][None, :]
            i, j = np.nonzero(other)
            if not len(i):
                continue
            same = np.empty(len(i), np.int32)
            for s in range(0, len(i), 65_536):
                e = slice(s, s + 65_536)
                same[e] = (left["regs"][i[e]] == part["regs"][j[e]]).sum(1)
            near = same >= 0.5 * REGISTERS  # six deviations below the threshold's share
            i, j = i[near], j[near]
            if not len(i):
                continue
            ra, rb = left["regs"][i], part["regs"][j]
            # Of the bands a pair shares, the first one answers for it.
            first = (ra.view(np.int64) == rb.view(np.int64)).argmax(1) == band
            i, j, ra, rb = i[first], j[first], ra[first], rb[first]
            if not len(i):
                continue
            good = credible((ra < rb).sum(1), (ra == rb).sum(1), (ra > rb).sum(1), left["n"][i], part["n"][j])
            for p, q in zip(i[good], j[good], strict=True):
                mine = (left["size"][p], -left["component"][p])
                yours = (part["size"][q], -part["component"][q])
                if mine <= yours:
                    found.add((int(left["id"][p]), int(part["component"][q])))
                else:
                    found.add((int(part["id"][q]), int(left["component"][p])))

    def finish():
        if held:

            def side(flag):
                rows = [h for h in held if h[0] == flag]
                return {
                    "id": np.array([h[1] for h in rows], np.int64),
                    "component": np.array([h[2] for h in rows], np.int64),
                    "size": np.array([h[3] for h in rows], np.int64),
                    "n": np.array([h[4] for h in rows], np.int64),
                    "regs": np.stack([h[5] for h in rows]) if rows else np.empty((0, REGISTERS), np.uint16),
                }
            fixed, moving = side(0), side(1)
            if len(fixed["id"]) and len(moving["id"]):
                compare(last[1], fixed, moving)
        held.clear()

    def flush():
        pairs = sorted(found)
        found.clear()
        x, target = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_pydict({"x": x, "target": target})

    last = None
    for rows in batches:
        regs = _as_registers(rows.column("bands"))
        names = ("bucket", "band", "row", "col", "side", "id", "component", "size", "n_shingles")
        columns = [rows.column(c).to_pylist() for c in names]
        for k, (bucket, band, row, col, side, *rest) in enumerate(zip(*columns, strict=True)):
            if (bucket, band, row, col) != last:
                finish()
                last = (bucket, band, row, col)
                if len(found) > 100_000:
                    yield flush()
            held.append((side, *rest, regs[k]))
    finish()
    yield flush()


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, band, id): every class in the buckets of its bands."""
    return classes.select(F.col("id"), F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "band", "id"
    )


def _rest(shared: DataFrame, membership: DataFrame, classes: DataFrame) -> DataFrame:
    """Credible pairs across components in one bucket: (x, target).

    In a bucket the members outside its leading component are compared with all
    members. Both sides are cut into blocks, and a row goes to the blocks of the
    other side only, so no task holds more than two blocks.
    """
    placed = shared.join(membership, "id")
    per = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (
        per.groupBy("bucket")
        .agg(
            F.count("*").alias("kinds"),
            F.sum("n").alias("all"),
            F.max(F.struct("n", "component")).alias("lead"),
        )
        .where("kinds > 1")
        .select(
            "bucket",
            F.col("lead.component").alias("leader"),
            F.ceil((F.col("all") - F.col("lead.n")) / BLOCK).cast("int").alias("rows"),
            F.ceil(F.col("all") / BLOCK).cast("int").alias("cols"),
        )
    )
    members = placed.join(mixed, "bucket")
    block = F.xxhash64("id", F.lit(9))
    names = ["bucket", "band", "row", "col", "side", "id", "component", "size"]
    fixed = (
        members.where("component <> leader")
        .withColumn("row", F.pmod(block, F.col("rows")).cast("int"))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)))
        .withColumn("side", F.lit(0))
        .select(names)
    )
    moving = (
        members.withColumn("col", F.pmod(block, F.col("cols")).cast("int"))
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
        .withColumn("side", F.lit(1))
        .select(names)
    )
    rows = fixed.union(moving).join(classes.select("id", "n_shingles", "bands"), "id")
    keys = ["bucket", "band", "row", "col"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return map_arrow(dealt, _across, "x long, target long").distinct()


def _texts(documents: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, one, text) of the wanted classes. A Bloom filter of fixed size keeps the
    other texts from being shuffled."""
    bits = documents.sparkSession.sparkContext.broadcast(bloom_filter(wanted, "id"))
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").where(may_contain(bits, "id"))
    return texts.join(wanted.join(classes.select("id", "one"), "id"), "id")


def linked_documents(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sketched = stored(sketches(documents), "sketches")
    classes = stored(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("one", "two")
        .agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("r"))
        .select(F.col("r.doc_id").alias("id"), "one", "two", "r.n_shingles", "r.bands"),
        "classes",
    )
    # Buckets of one class say nothing; the others' first class by hash is their hub.
    order = F.struct(F.xxhash64("id", F.lit(1)).alias("h"), "id")
    hubs = (
        _buckets(classes)
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min(order).alias("hub"))
        .where("n > 1")
        .select("bucket", F.col("hub.id").alias("hub"))
    )
    shared = stored(_buckets(classes).join(hubs, "bucket"), "buckets")
    stars = shared.where("id <> hub").select(F.col("id").alias("x"), F.col("hub").alias("target")).distinct()
    for name, side in (("x", "a"), ("target", "b")):
        sketch = classes.selectExpr(
            f"id AS {name}", f"n_shingles AS {side}_size", f"bands AS {side}_bands"
        )
        stars = stars.join(sketch, name)
    stars = stored(map_arrow(stars, _estimate, "x long, target long"), "stars")
    alone = stars.select(F.col("target").alias("id")).distinct().select("id", F.col("id").alias("component"))
    wanted = stars.select(F.col("x").alias("id")).union(alone.select("id")).distinct()
    links = stored(verified(stars, alone, _texts(documents, classes, wanted)), "star-links")
    # What the stars left apart.
    joined = components(links)
    ids = shared.select("id").distinct()
    membership = ids.join(joined, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    sizes = membership.groupBy("component").agg(F.count("*").alias("size"))
    membership = stored(membership.join(sizes, "component"), "membership")
    rest = stored(_rest(shared.select("bucket", "band", "id"), membership, classes), "rest")
    targets = rest.select(F.col("target").alias("component")).distinct()
    members = stored(membership.select("id", "component").join(targets, "component"), "members")
    wanted = rest.select(F.col("x").alias("id")).union(members.select("id")).distinct()
    more = stored(verified(rest, members, _texts(documents, classes, wanted)), "rest-links")
    final = components(links.union(more))
    component = (
        classes.join(final, "id", "left")
        .select("one", "two", F.coalesce("component", "id").alias("component_id"))
    )
    rows = sketched.join(component, ["one", "two"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return rows.withColumn("kept", F.col("doc_id") == F.col("component_id"))
