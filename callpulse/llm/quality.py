"""Quality: positive-unlabelled learning with the non-negative risk estimator.

A small network over text statistics is trained so that trusted positives score
high and the rest of the corpus, which nobody has labelled, scores low beyond the
positives it must contain: with class prior p, the risk is
p E+[loss(+1)] + max(0, Eu[loss(-1)] - p E+[loss(-1)]). The prior is estimated as
the share of positives among the labels that may be learned from; without known
negatives it is the mean of a labelled-or-not classifier on trusted positives
(Elkan and Noto). Held-out labels make the score a probability (Platt).

Null and empty texts have all statistics 0 and get that row's score. Labels that
are null or repeated with both values teach nothing. Without positives every
score is the prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import Words, bytes_where, map_arrow, stored, text_blocks
from callpulse.llm.learning import Platt, sample_of, sigmoid

#: Labelled rows and unlabelled rows that are learned from, at most (about).
LABELLED_ROWS, UNLABELLED_ROWS = 12_000, 12_000

FEATURES = """words word_length word_length_spread distinct repeated_next best_share longest_run
pair_distinct capitals shouted digits punctuation signs bars marks lines line_words short_lines
repeated_lines beyond_ascii space sentence_marks lone_signs glued_signs""".split()

_WORD = bytes_where(lambda b: b != 32 and not 9 <= b <= 13)
_LINE = bytes_where(lambda b: b != 10)


def _bytes_of(text: bytes) -> np.ndarray:
    return bytes_where(lambda b: b in text)


_UPPER = bytes_where(lambda b: 65 <= b <= 90)
_LOWER = bytes_where(lambda b: 97 <= b <= 122 or b >= 128)
_DIGIT, _BEYOND = bytes_where(lambda b: 48 <= b <= 57), bytes_where(lambda b: b >= 128)
_SIGNS = _bytes_of(b"#$%&*+=<>^~@\\_{}[]`")
_PUNCTUATION = bytes_where(lambda b: 32 < b < 127 and not chr(b).isalnum())
_SPACE = ~_WORD


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    size = len(offsets) - 1
    words, lines = Words(data, offsets, _WORD), Words(data, offsets, _LINE)
    count = np.diff(words.first)
    per_word, length = np.maximum(count, 1), np.maximum(np.diff(offsets), 1)

    def total(values, owner=words.text):
        return np.bincount(owner, values, size)

    def share(table):
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / length

    def inside(table):
        sums = np.concatenate([[0], np.cumsum(table[data])]) if len(data) else np.zeros(2, int)
        return sums[words.end] - sums[words.start]

    def distinct(hashes, owner):
        """The number of different values, and how often the commonest occurs."""
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        first = np.flatnonzero(new)
        runs = np.diff(np.append(first, len(h)))
        most = np.zeros(size)
        np.maximum.at(most, o[first], runs)
        return np.bincount(o[first], minlength=size), most

    long = words.end - words.start
    mean = total(long) / per_word
    spread = np.sqrt(np.maximum(total(long.astype(float) ** 2) / per_word - mean**2, 0))
    different, most = distinct(words.hash, words.text)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    change = np.flatnonzero(~same)
    runs = np.diff(np.append(change, len(same)))
    longest = np.zeros(size)
    np.maximum.at(longest, words.text[change], runs)
    pairs, whole = words.grams(2)
    pair_owner = words.text[: len(pairs)][whole]
    pair_kinds, _ = distinct(pairs[whole], pair_owner)
    pair_count = np.maximum(np.bincount(pair_owner, minlength=size), 1)
    line_count = np.maximum(np.diff(lines.first), 1)
    line_kinds, _ = distinct(lines.hash, lines.text)
    upper, lower, signs = inside(_UPPER), inside(_LOWER), inside(_SIGNS)
    letters = upper + lower
    columns = [
        np.log1p(count), mean, spread, different / per_word, total(same) / per_word,
        most / per_word, longest / per_word, pair_kinds / pair_count, share(_UPPER),
        total((upper >= 2) & (lower == 0)) / per_word, share(_DIGIT), share(_PUNCTUATION),
        share(_SIGNS), share(_bytes_of(b"|")), share(_bytes_of(b"!?")), np.log1p(np.diff(lines.first)),
        np.log1p(count / line_count), total(lines.end - lines.start < 30, lines.text) / line_count,
        1 - line_kinds / line_count * (line_kinds > 0), share(_BEYOND), share(_SPACE),
        share(_bytes_of(b".,;:")), total(letters == 0) / per_word, total((signs > 0) & (letters > 0)) / per_word,
    ]
    return np.stack(columns, 1)


class RiskNet:
    """One hidden layer, trained with Adam on the non-negative risk (sigmoid loss)."""

    def __init__(self, inputs: int, hidden: int = 24, seed: int = 4):
        r = np.random.default_rng(seed)
        self.p = {
            "w": r.normal(0, inputs**-0.5, (inputs, hidden)),
            "b": np.zeros(hidden),
            "v": r.normal(0, hidden**-0.5, hidden),
            "c": np.zeros(1),
        }

    def decide(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p["w"] + self.p["b"]) @ self.p["v"] + self.p["c"][0]

    def _gradient(self, x, back):
        h = np.tanh(x @ self.p["w"] + self.p["b"])
        deep = back[:, None] * self.p["v"] * (1 - h**2)
        return {"w": x.T @ deep, "b": deep.sum(0), "v": h.T @ back, "c": np.array([back.sum()])}

    def fit(self, positive, unlabelled, prior, epochs=60, batch=512, rate=0.01, seed=4):
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        steps = max(1, len(unlabelled) // batch)
        for _ in range(epochs):
            mixed = np.array_split(r.permutation(len(unlabelled)), steps)
            for rows in mixed:
                x = positive[r.integers(0, len(positive), min(batch, len(positive)))]
                u = unlabelled[rows]
                gx, gu = sigmoid(self.decide(x)), sigmoid(self.decide(u))
                negative = gu.mean() - prior * gx.mean()
                slope_x, slope_u = gx * (1 - gx) / len(x), gu * (1 - gu) / len(u)
                if negative >= 0:
                    back_x, back_u = -2 * prior * slope_x, slope_u
                else:  # undo the overfitted part instead
                    back_x, back_u = prior * slope_x, -slope_u
                one, two = self._gradient(x, back_x), self._gradient(u, back_u)
                t += 1
                for k in self.p:
                    g = one[k] + two[k] + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return self


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    net: RiskNet | None
    calibrate: Platt | None
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(x), self.prior)
        decided = self.net.decide(self._standard(x))
        return self.calibrate(decided) if self.calibrate else sigmoid(decided)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)


def _with_features(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, labels (-1: none) and draw of a bounded sample."""

    def run(batches):
        for part, data, offsets in text_blocks(batches, "text"):
            x = text_features(data, offsets)
            yield pa.RecordBatch.from_pydict(
                {
                    "x": pa.array([r.astype("<f8").tobytes() for r in x], pa.binary()),
                    "label": part.column("label"),
                    "draw": part.column("draw"),
                }
            )

    found = map_arrow(rows, run, "x binary, label int, draw int").toArrow()
    x = np.frombuffer(b"".join(found["x"].to_pylist()), "<f8").reshape(-1, len(FEATURES))
    y, draw = found["label"].to_numpy(), found["draw"].to_numpy()
    order = np.lexsort((*x.T[:6], draw, y))  # the rows' order must not matter
    return x[order], y[order], draw[order]


def _elkan_noto(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from a classifier of labelled against unlabelled rows."""
    net = RiskNet(positive.shape[1]).fit(positive, unlabelled, 0.5, epochs=10)
    on = sigmoid(net.decide(positive)).mean()
    return float(np.clip(sigmoid(net.decide(unlabelled)).mean() / max(on, 1e-6), 0.05, 0.95))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED_ROWS,
    unlabelled: int = UNLABELLED_ROWS,
) -> QualityModel:
    """Learns from ``labels`` (doc_id, label 0/1) and from all texts as unlabelled
    ones, about so many rows of each."""
    one_label = (
        labels.where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", F.col("label").cast("int"))
    )
    drawn = F.broadcast(sample_of(one_label, "doc_id", labelled))
    texts = documents.select("doc_id", "text")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(4)).cast("int").alias("draw")
    web = sample_of(texts, "doc_id", unlabelled, seed=19)
    sample = stored(
        texts.join(drawn, "doc_id").select("text", "label", draw).union(
            web.select("text", F.lit(-1), draw)
        ),
        "quality-sample",
    )
    x, y, draw = _with_features(sample)
    seen = x if len(x) else np.zeros((1, len(FEATURES)))
    model = QualityModel(seen.mean(0), seen.std(0) + 1e-6, None, None, 0.5)
    x = model._standard(x)
    known = y >= 0
    positive, mixed = x[(y == 1) & (draw > 0)], x[y == -1]
    if not len(positive) or not len(mixed):
        return model
    if (y == 0).any():
        model.prior = float((y[known] == 1).mean())
    else:
        model.prior = _elkan_noto(positive, mixed)
    model.net = RiskNet(x.shape[1]).fit(positive, mixed, model.prior)
    held = known & (draw == 0)
    if not 0 < (y[held] == 1).sum() < held.sum():
        held = known
    if (y[held] == 0).any():
        model.calibrate = Platt().fit(model.net.decide(x[held]), y[held].astype(float))
    return model


def score(documents: DataFrame, model: QualityModel, column: str = "quality") -> DataFrame:
    """The documents, all their columns, with a score from 0 to 1 in ``column``, which
    replaces an input column of that name."""
    documents = documents.drop(column)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select("*", F.lit(0.0).alias(column)).schema

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            found = pa.array(sent.value.score(text_features(data, offsets)))
            yield pa.RecordBatch.from_arrays([*rows.columns, found], names=[*rows.schema.names, column])

    return map_arrow(documents, run, schema)
