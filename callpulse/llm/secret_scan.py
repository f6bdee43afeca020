"""Secrets: fixed rules, and a character convolutional network for what they miss.

Rules find assignments, access keys and long hexadecimal runs. Every other long
run of key characters is a candidate: the network reads a window that slides over
the whole of it, with its surroundings, and says how likely a secret is there; the
highest score counts. It is trained on labelled
findings: the candidates of all documents, labelled by the rules, and generated keys,
cards, addresses, versions, names. Tasks train on their shards of the windows, and
after each epoch the networks are averaged. A held-out quarter calibrates
the network (Platt) and sets the threshold: the highest that keeps the wanted
recall. Findings of the rules stay whatever their score; a likely candidate is left
out only if they cover all its letters and digits.

Places are code points, ends exclusive. Null and empty texts have no findings.
Texts of any length are read whole; long ones are not split.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import bytes_where, map_arrow, stored, text_blocks
from callpulse.llm.learning import Platt, sigmoid

# The rules.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ["assign", "access", "hex", "model"]

#: What the corpus's windows of a label weigh together, at most, where a generated one
#: weighs 1. All of them count, each by its share.
LABEL_WEIGHT = 2_000
#: Windows of a shard, about; windows of a label in each shard, at least, if there are
#: as many: those of a rare label are in several shards.
SHARD = 8192
LEAST_LABELLED = 1024
EPOCHS = 12
#: Parts of 1 in which log odds are counted for calibration, and the largest log odds.
CELLS, HIGHEST = 1024, 64
#: Parts of 1 in which networks are added up: whole numbers have one sum in any order.
FIXED = 2.0**40
#: Share of labelled secrets that the threshold must keep.
RECALL = 0.97
LEAST_CANDIDATE = 16
LEFT, OWN, RIGHT = 24, 40, 8
WIDTH = LEFT + OWN + RIGHT
#: From one window of a candidate to the next: any 33 characters are in one window.
STEP = 8
#: Characters of a longer secret that make a window one of a secret.
HELD = 24
#: Windows that are read at once.
READ = 4096

FINDINGS = "array<struct<kind:string,start:int,end:int,score:double>>"

_FINDING_LISTS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    )
)
_KEY_BYTES = bytes_where(lambda b: b < 128 and (chr(b).isalnum() or b in b"+/_=-."))
_PLAIN = bytes_where(lambda b: b < 128 and chr(b).isalnum())


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """What the rules find, leftmost and non-overlapping per rule."""
    raw = text.encode().lower()
    spans = []
    if any(word in raw for word in KEYWORDS):
        spans += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED
        ]
    if "AKIA" in text:
        spans += [
            ("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS
        ]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def candidates(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte runs of key characters that are long and hold a letter or digit: (start,
    end). Texts are separated by a byte that is no key's."""
    inside = np.concatenate([[0], _KEY_BYTES[data].astype(np.int8), [0]])
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - start >= LEAST_CANDIDATE
    start, end = start[long], end[long]
    plain = np.concatenate([[0], np.cumsum(_PLAIN[data])])
    good = plain[end] > plain[start]
    return start[good], end[good]


def slid(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows over each candidate: its number, and where in it the window begins."""
    rest = np.maximum(end - start - OWN, 0)
    number = 1 + -(-rest // STEP)
    which = np.repeat(np.arange(len(start)), number)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
    return which, np.minimum(nth * STEP, rest[which])


def windows(
    data: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    at: np.ndarray | int = 0,
) -> np.ndarray:
    """The bytes before, of and after each candidate, of it those from ``at`` on; 0
    outside the candidate's own text, which is from ``low`` to ``high``."""

    def read(place, low, high):
        inside = (place >= low) & (place < high)
        return np.where(inside, data[np.clip(place, 0, max(len(data) - 1, 0))], 0)

    begin = start + at
    before = read(start[:, None] + np.arange(-LEFT, 0), low[:, None], high[:, None])
    own = read(begin[:, None] + np.arange(OWN), 0, end[:, None])
    after = read(end[:, None] + np.arange(RIGHT), low[:, None], high[:, None])
    return np.minimum(np.concatenate([before, own, after], 1), 127).astype(np.uint8)


class CharacterNet:
    """Embedding, one convolution, the largest response before, in and after the
    candidate, and a logistic layer. Trained with Adam."""

    def __init__(self, embed=8, filters=24, width=5, seed=5):
        r = np.random.default_rng(seed)
        self.width = width
        self.p = {
            "e": r.normal(0, 0.5, (128, embed)),
            "w": r.normal(0, (2 / (width * embed)) ** 0.5, (width * embed, filters)),
            "c": np.zeros(filters),
            "v": r.normal(0, 0.1, 3 * filters),
            "d": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.first = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.decay = np.ones(2)  # of the two moments, over all steps so far
        at = np.arange(WIDTH - width + 1)
        self.zones = [at < LEFT - 2, (at >= LEFT - 2) & (at < LEFT + OWN - 2), at >= LEFT + OWN - 2]

    def _forward(self, x):
        e = self.p["e"][x]
        steps = np.lib.stride_tricks.sliding_window_view(e, self.width, axis=1)
        steps = steps.transpose(0, 1, 3, 2).reshape(len(x), -1, self.p["w"].shape[0])
        h = np.maximum(steps @ self.p["w"] + self.p["c"], 0)
        tops = [np.where(z[None, :, None], h, -1).argmax(1) for z in self.zones]
        pooled = np.concatenate([np.take_along_axis(h, t[:, None], 1)[:, 0] for t in tops], 1)
        return steps, tops, pooled, pooled @ self.p["v"] + self.p["d"][0]

    def state(self) -> np.ndarray:
        """All numbers of the network and of Adam, as one array."""
        sets = (self.p, self.first, self.second)
        return np.concatenate([self.decay, *(v.ravel() for s in sets for v in s.values())])

    def load(self, state: np.ndarray) -> CharacterNet:
        self.decay, at = state[:2].copy(), 2
        for s in (self.p, self.first, self.second):
            for k, v in s.items():
                s[k] = state[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        return self

    def fit(self, x, y, epochs=EPOCHS):
        for epoch in range(epochs):
            self.epoch(x, y, np.ones(len(y)), seed=(1, epoch))
        return self

    def epoch(self, x, y, weight, seed, batch=64, rate=0.004):
        """One pass over all rows."""
        filters, embed = len(self.p["c"]), self.p["e"].shape[1]
        weight = weight / weight.mean()
        order = np.random.default_rng(seed).permutation(len(y))
        for rows in np.array_split(order, max(1, len(y) // batch)):
            xs = x[rows]
            steps, tops, pooled, score = self._forward(xs)
            d = (weight[rows] * (sigmoid(score) - y[rows]) / len(rows)).astype(np.float32)
            g = {"v": pooled.T @ d, "d": d.sum(keepdims=True), "c": np.zeros_like(self.p["c"])}
            g["w"], g["e"] = np.zeros_like(self.p["w"]), np.zeros_like(self.p["e"])
            for z, top in enumerate(tops):
                part = slice(z * filters, (z + 1) * filters)
                back = d[:, None] * self.p["v"][part] * (pooled[:, part] > 0)
                g["c"] += back.sum(0)
                seen = np.take_along_axis(steps, top[:, :, None], 1)  # rows, filters, inputs
                g["w"] += np.einsum("nf,nfi->if", back, seen)
                flow = back[:, :, None] * self.p["w"].T
                read = np.take_along_axis(
                    xs, (top[:, :, None] + np.arange(self.width)).reshape(len(rows), -1), 1
                )
                place = read.reshape(-1, 1) * np.int64(embed) + np.arange(embed)
                g["e"] += np.bincount(place.ravel(), flow.ravel(), g["e"].size).reshape(-1, embed)
            self.decay *= (0.9, 0.999)
            for k in self.p:
                self.first[k] = 0.9 * self.first[k] + 0.1 * g[k]
                self.second[k] = 0.999 * self.second[k] + 0.001 * g[k] ** 2
                rise = (self.first[k] / (1 - self.decay[0])) / (
                    np.sqrt(self.second[k] / (1 - self.decay[1])) + 1e-7
                )
                self.p[k] = (self.p[k] - rate * rise).astype(np.float32)

    def decide(self, x: np.ndarray) -> np.ndarray:
        parts = [self._forward(x[k : k + 512])[3] for k in range(0, len(x), 512)]
        return np.concatenate([*parts, np.empty(0)]).astype(float)


def generated(count: int, seed: int = 3, framed: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Labelled findings of our own: windows, and 1 for keys. With ``framed`` the keys
    are parts of longer runs, and every window that slides over a run is one."""
    r = np.random.default_rng(seed)
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(r.choice(list(alphabet), r.integers(low, high + 1)))

    def word() -> str:
        return some("eeetaaoinshrdlu", 2, 9)

    def number(n: int) -> str:
        return some(digit, n, n)

    keys = [
        lambda: some(lower + upper + digit, 24, 64),
        lambda: some(lower + upper + digit + "+/", 32, 88),
        lambda: some("0123456789abcdef", 24, 64),
        lambda: some(upper + digit, 20, 40),
        lambda: some(lower + digit, 20, 40),
        lambda: some(lower, 2, 4) + "_" + some(lower + upper + digit, 24, 40),
        lambda: "-".join([some(lower, 3, 5), number(12), some(lower + upper + digit, 24, 32)]),
        lambda: ".".join(some(lower + upper + digit + "_-", 20, 40) for _ in range(3)),
        lambda: some(lower + upper, 24, 64),
        lambda: some(lower + upper, 12, 30) + number(1) + some(lower + upper, 12, 30),
    ]
    others = [
        lambda: number(16),
        lambda: "-".join(number(4) for _ in range(4)),
        lambda: some(digit, 16, 30),
        lambda: "-".join([number(4), number(2), number(2)]) + "T" + number(6) + "." + number(3),
        lambda: ".".join(some(digit, 3, 3) for _ in range(5)),
        lambda: word() + "." + number(2) + "_" + word() + number(1) + ".example.com",
        lambda: "/".join(word() for _ in range(4)) + "/" + number(4),
        lambda: "-".join(word() for _ in range(4)) + "-" + number(4),
        lambda: "_".join(word() for _ in range(3)) + "_v" + number(2) + "." + number(1),
        lambda: word() * 4 + number(2),
        lambda: some("=-_.", 16, 40) + number(2),
        lambda: word().title() + word().title() + word().title() + number(4),
        lambda: some(digit, 1, 1) * 30,
        lambda: "/".join(word() for _ in range(r.integers(3, 20))),
        lambda: ".".join(word() for _ in range(r.integers(4, 16))),
        lambda: r.choice(list("-_")).join(word() for _ in range(r.integers(4, 16))),
        lambda: "".join(word().title() for _ in range(r.integers(3, 9))),
        lambda: "".join(word() for _ in range(r.integers(3, 6))),
        lambda: "".join(word() for _ in range(r.integers(3, 6))).upper(),
        lambda: "_".join(word().upper() for _ in range(r.integers(3, 9))),
        lambda: some(lower + upper, 1, 1) * 30,
        lambda: "https" + "".join("/" + word() + r.choice(["", number(2)]) for _ in range(r.integers(3, 16))),
        lambda: "=".join(word() + r.choice(["", number(4)]) for _ in range(r.integers(3, 12))),
    ]
    hints = ["key ", "auth=", "credential: ", "bearer ", "private ", ' "', "= ", ": "]
    xs, ys = [], []
    for k in range(count):
        good = k % 2 == 0
        own = keys[r.integers(len(keys))]() if good else others[r.integers(len(others))]()
        hint = hints[r.integers(len(hints))] if r.random() < (0.4 if good else 0.25) else " "
        before = " ".join(word() for _ in range(5)) + hint
        after = r.choice([" ", '" ', "\n", ". "]) + word() + " " + word()
        lead = tail = ""
        if framed and good:
            lead = others[r.integers(len(others))]() + r.choice(list("/=._-"))
            tail = r.choice(["", "/" + word() + "." + word()])
        text = np.frombuffer((before + lead + own + tail + after).encode(), np.uint8)
        start = np.array([len(before)])
        end = start + len(lead + own + tail)
        which, at = slid(start, end) if framed else (np.array([0]), np.array([0]))
        held = np.array([[len(lead), len(lead + own)]] if good else [], int).reshape(-1, 2)
        y = _labels([held], at, np.minimum(at + OWN, end[0] - start[0]), len(at) == 1)
        told = y >= 0
        low, high = np.zeros(len(which), int), np.full(len(which), len(text))
        xs.append(windows(text, start[which], end[which], low, high, at)[told])
        ys += y[told].astype(float).tolist()
    return np.concatenate(xs), np.array(ys)


def _labels(
    secrets: list[np.ndarray], start: np.ndarray, end: np.ndarray, alone: np.ndarray | bool
) -> np.ndarray:
    """Whether the characters of each window hold a secret: 1, 0, or -1 if too little of
    one. The only window of a candidate holds what the candidate does. Secrets are
    arrays of (start, end), each in order and without overlaps."""
    shared, whole = np.zeros(len(start), np.int64), np.zeros(len(start), bool)
    for held in secrets:
        s, e = held.T
        near, last = np.searchsorted(e, start, "right"), np.searchsorted(s, end, "left")
        for _ in range(int((last - near).max(initial=0))):
            rows = np.flatnonzero(near < last)
            a, b = s[near[rows]], e[near[rows]]
            own = np.minimum(b, end[rows]) - np.maximum(a, start[rows])
            shared[rows] = np.maximum(shared[rows], own)
            whole[rows] |= (start[rows] <= a) & (b <= end[rows])
            near = near + 1
    return np.where(shared <= 0, 0, np.where(alone | whole | (shared >= HELD), 1, -1))


@dataclass
class SecretModel:
    net: CharacterNet
    calibrate: Platt
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrate(self.net.decide(x))

    def highest(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> np.ndarray:
        """The score of each candidate: that of its likeliest window. Its text is from
        ``low`` to ``high``."""
        best = np.full(len(start), -np.inf)
        which, at = slid(start, end)
        for k in range(0, len(which), READ):
            own, begin = which[k : k + READ], at[k : k + READ]
            x = windows(data, start[own], end[own], low[own], high[own], begin)
            np.maximum.at(best, own, self.net.decide(x))
        return self.calibrate(best)


def _found(data: np.ndarray, offsets: np.ndarray, texts: list[str]):
    """Per text: the spans of the rules, and where it starts and ends in the block;
    and all candidates of the block with text, byte and code point places."""
    spread = np.insert(data, offsets[1:-1], 32)  # keeps runs of two texts apart
    moved = offsets + np.arange(len(offsets))  # where each text starts now
    moved[-1] -= 1
    stop = np.append(moved[1:-1] - 1, moved[-1])
    start, end = candidates(spread)
    owner = np.searchsorted(moved[:-1], start, "right") - 1
    points = np.concatenate([[0], np.cumsum((spread & 0xC0) != 0x80)])
    own = points[moved[owner]] if len(owner) else start
    return (
        [rule_spans(t) if t else [] for t in texts],
        spread, np.stack([moved[:-1], stop], 1), points, owner, start, end, points[start] - own, points[end] - own,
    )


def _covered(spans: list[tuple[str, int, int]], start: int, end: int, text: str) -> bool:
    """Whether no letter or digit of the place is outside the spans."""
    for _, s, e in sorted(spans, key=lambda f: f[1]):
        if s >= end or any(c.isalnum() for c in text[start:s]):
            break
        start = max(start, e)
    return not any(c.isalnum() for c in text[start:end])


def _labelled(batches):
    """Windows of the corpus's candidates, labelled by the rules."""
    for rows, data, offsets in text_blocks(batches, "text"):
        texts = rows.column("text").to_pylist()
        rules, spread, bounds, points, owner, start, end, first, last = _found(
            data, offsets, texts
        )
        begun = points[bounds[:, 0]]  # code points of the block before each text
        secrets = [
            np.array(
                [(b + f[1], b + f[2]) for b, own in zip(begun, rules, strict=True) for f in own if f[0] == kind],
                np.int64,
            ).reshape(-1, 2)
            for kind in KINDS[:-1]
        ]
        first, last = first + begun[owner], last + begun[owner]
        which, at = slid(start, end)
        alone = np.bincount(which, minlength=len(start)) == 1
        for k in range(0, len(which), READ):
            own, begin = which[k : k + READ], at[k : k + READ]
            place = first[own] + begin
            y = _labels(secrets, place, np.minimum(place + OWN, last[own]), alone[own])
            told = y >= 0
            low, high = bounds[owner[own]].T
            x = windows(spread, start[own], end[own], low, high, begin)[told]
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array([v.tobytes() for v in x], pa.binary()), "y": pa.array(y[told], pa.int32())}
            )


def _arrays(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.uint8).reshape(-1, WIDTH)
    return x, rows.column("y").to_numpy()


def _shards(batches):
    """The rows of each shard, which come one after the other: number, windows, labels."""
    held, number = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard").to_numpy()
        borders = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
        for first, last in zip(borders[:-1], borders[1:], strict=True):
            if held and shard[first] != number:
                yield int(number), *_arrays(pa.Table.from_batches(held))
                held = []
            number = shard[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield int(number), *_arrays(pa.Table.from_batches(held))


def _dealt(found: DataFrame, counts: dict[int, int]) -> tuple[DataFrame, dict[int, float]]:
    """The windows by shards, those of a shard together, and what a window of each label
    weighs in a shard, in which every generated one weighs 1."""
    shards = max(1, round(sum(counts.values()) / SHARD))
    copies = {y: min(shards, -(-LEAST_LABELLED * shards // max(n, 1))) for y, n in counts.items()}
    own = F.when(F.col("y") == 1, F.lit(copies[1])).otherwise(F.lit(copies[0]))
    nth = F.explode(F.sequence(F.lit(0), own - 1))
    first = F.pmod(F.xxhash64("draw", F.lit(13)), F.lit(shards))
    step = F.floor(F.col("nth") * shards / own)
    files = max(min(shards, 256), shards // 32)
    dealt = (
        found.select("*", nth.alias("nth"))
        .select(((first + step) % shards).cast("int").alias("shard"), "draw", "x", "y")
        .repartition(files, "shard")
        .sortWithinPartitions("shard", "draw", "x", "y")
        .select("shard", "x", "y")
    )
    return stored(dealt, "secret-shards"), {y: shards / c for y, c in copies.items()}


def _trained(found: DataFrame, weight: dict[int, float], x: np.ndarray, y: np.ndarray) -> CharacterNet:
    """Trains on all windows found, each weighing what its label's do, and on generated
    ones. In each epoch a task trains the network on its shards, one by one from the same
    start, and the networks of all shards are averaged, with Adam's moments."""
    counts = {k: 0 for k in (0, 1)} | dict(found.groupBy("y").count().collect())
    if not any(counts.values()):
        return CharacterNet().fit(x, y)
    dealt, share = _dealt(found, counts)
    weights = np.array([weight[k] * share[k] for k in (0, 1)])
    sent = found.sparkSession.sparkContext.broadcast((x, y))
    state = CharacterNet().state()
    for epoch in range(EPOCHS):

        def run(batches, state=state, epoch=epoch):
            made, made_y = sent.value
            total = np.zeros(len(state) + 1, np.int64)  # and the number of shards
            for number, own, own_y in _shards(batches):
                w = np.concatenate([np.ones(len(made_y)), weights[own_y]])
                net = CharacterNet().load(state)
                net.epoch(
                    np.concatenate([made, own]), np.concatenate([made_y, own_y]), w, (1, epoch, number)
                )
                total += np.append(np.rint(net.state() * FIXED).astype(np.int64), 1)
            if total[-1]:
                yield pa.RecordBatch.from_pydict({"state": pa.array([total.tolist()], pa.list_(pa.int64()))})

        sums = (
            map_arrow(dealt, run, "state array<long>")
            .select(F.posexplode("state").alias("at", "value"))
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
            .toPandas()
            .sort_values("at")["value"]
            .to_numpy(np.int64)
        )
        state = sums[:-1] / FIXED / sums[-1]
    return CharacterNet().load(state)


def _counted(found: DataFrame, net: CharacterNet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How the network decides on windows: log odds, rounded down to cells, labels, and
    how many windows have both. The cells are some hundred thousand at most."""
    sent = found.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            x, y = _arrays(batch)
            cell = np.floor(np.clip(sent.value.decide(x), -HIGHEST, HIGHEST) * CELLS)
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(cell.astype(np.int64)), "y": pa.array(y, pa.int32())}
            )

    rows = (
        map_arrow(found.select("x", "y"), run, "cell long, y int")
        .groupBy("cell", "y")
        .count()
        .orderBy("cell", "y")
        .toPandas()
    )
    return rows["cell"].to_numpy(float) / CELLS, rows["y"].to_numpy(float), rows["count"].to_numpy(float)


def _kept(scores: np.ndarray, weight: np.ndarray, recall: float) -> float:
    """The highest score from which at least that share of the weight lies."""
    order = np.argsort(scores, kind="stable")
    before = np.cumsum(weight[order]) - weight[order]
    return float(scores[order][before <= (1 - recall) * weight.sum()][-1])


def fit(documents: DataFrame, recall: float = RECALL) -> SecretModel:
    """Trains on the candidates of all documents and on generated findings."""
    found = map_arrow(documents.select("text"), _labelled, "x binary, y int").distinct()
    found = stored(found.withColumn("draw", F.xxhash64("x")), "secret-windows")
    counts = dict(found.groupBy("y").count().collect())
    weight = {k: min(1.0, LABEL_WEIGHT / counts.get(k, 1)) for k in (0, 1)}
    x, y = generated(4_000)
    more_x, more_y = generated(800, seed=4, framed=True)
    x, framed = np.concatenate([x, more_x]), np.repeat([False, True], [len(y), len(more_y)])
    y = np.concatenate([y, more_y])
    order = np.random.default_rng(2).permutation(len(y))
    x, y, framed = x[order], y[order], framed[order]
    cut = len(y) * 3 // 4
    held_out = F.pmod(F.xxhash64("draw", F.lit(11)), F.lit(4)) == 0
    net = _trained(found.where(~held_out), weight, x[:cut], y[:cut])
    decided, labels, number = _counted(found.where(held_out), net)
    x, y, framed = x[cut:], np.concatenate([y[cut:], labels]), framed[cut:]
    decided = np.concatenate([net.decide(x), decided])
    framed = np.concatenate([framed, np.zeros(len(labels), bool)])
    number = number * np.array([weight[k] for k in labels.astype(int)])
    weights = np.concatenate([np.ones(len(x)), number])
    calibrate = Platt().fit(decided, y, weights)
    scores = calibrate(decided)
    kept = []  # keys of their own and keys in longer runs each keep the recall
    for kind in (False, True):
        positive = (y == 1) & (framed == kind)
        kept.append(_kept(scores[positive], weights[positive], recall))
    return SecretModel(net, calibrate, min(kept))


def _covered_up(text: str, findings: list[dict]) -> str:
    """Every finding replaced by its kind in brackets; overlapping ones are one."""
    out, at = [], 0
    for f in findings:
        if f["start"] >= at:
            out += [text[at : f["start"]], f"[{f['kind']}]"]
        at = max(at, f["end"])
    return "".join([*out, text[at:]])


def find(documents: DataFrame, model: SecretModel, redact: bool = False) -> DataFrame:
    """The documents, all their columns, with ``findings``: kind, start, end, score,
    by start and then kind. An input column of that name is replaced.

    With ``redact`` the texts come back with the kind of each finding in brackets in
    its place; the findings' places are still those of the text as it was.
    """
    documents = documents.drop("findings")
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select("*", F.array().cast(FINDINGS).alias("findings")).schema
    rank = {kind: k for k, kind in enumerate(KINDS)}

    def run(batches):
        judge = sent.value
        for rows, data, offsets in text_blocks(batches, "text"):
            texts = rows.column("text").to_pylist()
            rules, spread, bounds, points, owner, start, end, first, last = _found(
                data, offsets, texts
            )
            found = [[] for _ in rules]
            scores = judge.highest(spread, start, end, *bounds[owner].T)
            near = scores >= judge.threshold
            for o, a, b, s in zip(owner[near], first[near], last[near], scores[near], strict=True):
                if not _covered(rules[o], a, b, texts[o]):
                    found[o].append(("model", int(a), int(b), float(s)))
            # The rules' findings are scored with their surroundings as well.
            flat = [(o, *span) for o, spans in enumerate(rules) for span in spans]
            if flat:
                text = bounds[[o for o, *_ in flat]]
                wanted = points[text[:, :1]] + [[a, b] for _, _, a, b in flat]
                place = np.searchsorted(points, wanted, "right") - 1
                scores = judge.highest(spread, *place.T, *text.T)
                for (o, kind, a, b), s in zip(flat, scores, strict=True):
                    found[o].append((kind, a, b, float(s)))
            names = ("kind", "start", "end", "score")
            for own in found:
                own.sort(key=lambda f: (f[1], rank[f[0]]))
            lists = [[dict(zip(names, f, strict=True)) for f in own] for own in found]
            if redact and any(lists):
                for k, own in enumerate(lists):
                    if own:
                        texts[k] = _covered_up(texts[k], own)
                place = rows.schema.get_field_index("text")
                rows = rows.set_column(place, rows.schema.field(place), pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(lists, _FINDING_LISTS)], names=[*rows.schema.names, "findings"]
            )

    return map_arrow(documents, run, schema)
