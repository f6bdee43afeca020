"""Toxicity: boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words and word beginnings that labelled toxic texts hold
far more often than others. Per text the features are lexicon densities, how near
a hit stands to a second person, capitals, punctuation and obfuscation rates.

A null or empty text has all features 0 and gets that row's score. Rows without
doc_id are scored like others. Labels that are null or repeated with both values
teach nothing. Without labels of both kinds every score is the share of ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import Words, bytes_where, map_arrow, mix, stored, text_blocks
from callpulse.llm.learning import BoostedTrees, Isotonic, sample_of

#: Labelled rows that are learned from, at most (about).
LABELLED_ROWS = 16_000
#: Entries of the lexicon, at most.
LEXICON_SIZE = 20_000
#: How many times likelier in toxic texts an entry is, in logarithms.
LEAST_ODDS = 1.3
PREFIXES = (4, 5, 6)
#: Parts of the sample that are left out in turn to score them for calibration.
FOLDS = 4

# Second person, in four languages.
SECOND_PERSON = """you your yours yourself u ur du dich dir dein deine deiner ihr euch euer
tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros""".split()

# Common insults, in four languages; the rest of the lexicon is learned.
LISTED = """idiot idiots stupid moron morons loser losers pathetic worthless scum trash clown
disgusting dumb fool jerk creep ugly garbage imbecile freak coward filth vermin scumbag
dumm idioten trottel versager abschaum widerlich dreckig ekelhaft
stupide imbécile raté ordure dégoûtant minable crétin abruti
idiota estúpido estúpida imbécil basura asqueroso perdedor escoria patético""".split()

# Signs written for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = """hits hit_density best_weight weight_density prefix_hits prefix_density prefix_best
hidden_hits listed_hits listed_density near_person near_share person_density capitals shouted marks punctuation digits
letters_apart mixed_words stretched words""".split()

_LETTERS = bytes_where(lambda b: chr(b).isalnum() and b < 128 or b >= 128 or b == 39)
_WITH_SIGNS = bytes_where(lambda b: _LETTERS[b] or b in b"@$")
_READ = np.arange(256, dtype=np.uint8)
for sign, letter in LOOKALIKES.items():
    _READ[ord(sign)] = ord(letter)
_DIGITS = bytes_where(lambda b: 48 <= b <= 57)
_UPPER = bytes_where(lambda b: 65 <= b <= 90)
_ALPHA = bytes_where(lambda b: chr(b).isalpha() and b < 128 or b >= 128)
_MARKS = bytes_where(lambda b: b in b"!?")
_PUNCTUATION = bytes_where(lambda b: 32 < b < 127 and not chr(b).isalnum())


def _hashes_of(listed: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(listed).encode(), np.uint8)
    return np.sort(Words(raw, np.array([0, len(raw)]), _LETTERS).hash)


def _prefix_hashes(words: Words, size: int) -> np.ndarray:
    """The hash of each word's first bytes, 0 for shorter words."""
    end = words.start + size
    long = end < words.end
    found = words.hash_of(words.start, np.where(long, end, words.start))
    return np.where(long, mix(found + np.uint64(size)), np.uint64(0))


def _present(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value, or -1."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[place] == wanted, place, -1)


@dataclass
class Lexicon:
    keys: np.ndarray
    weights: np.ndarray

    def weigh(self, hashes: np.ndarray) -> np.ndarray:
        place = _present(self.keys, hashes)
        return np.where(place >= 0, np.append(self.weights, 0.0)[place], 0.0)


def _entries(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Every word and beginning of a word, with its text; each once per text."""
    parts = [words.hash, *(_prefix_hashes(words, size) for size in PREFIXES)]
    text = np.tile(words.text, len(parts))
    keys = np.concatenate(parts)
    text, keys = text[keys != 0], keys[keys != 0]
    order = np.lexsort((keys, text))
    text, keys = text[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return text[new], keys[new]


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and entry: in how many texts of each part and label it stands."""
    for rows, data, offsets in text_blocks(batches, "text"):
        text, keys = _entries(Words(data, offsets, _LETTERS))
        part = rows.column("part").to_numpy(zero_copy_only=False)
        toxic = rows.column("label").to_numpy(zero_copy_only=False)
        kind = (part * 2 + toxic)[text]
        found, place = np.unique(keys, return_inverse=True)
        counts = {
            f"n{k}": np.bincount(place[kind == k], minlength=len(found)) for k in range(4)
        }
        yield pa.RecordBatch.from_pydict({"key": found.view(np.int64), **counts})


def _lexicon(counted, sizes: np.ndarray, parts: tuple[int, ...]) -> Lexicon:
    toxic = sum(counted[f"n{2 * p + 1}"].to_numpy(float) for p in parts)
    clean = sum(counted[f"n{2 * p}"].to_numpy(float) for p in parts)
    toxic_size = max(sum(sizes[2 * p + 1] for p in parts), 1)
    clean_size = max(sum(sizes[2 * p] for p in parts), 1)
    share = toxic_size / (toxic_size + clean_size)
    odds = np.log((toxic + 10 * share) / toxic_size) - np.log((clean + 10 * (1 - share)) / clean_size)
    good = np.flatnonzero((odds >= LEAST_ODDS) & (toxic >= 2))
    good = good[np.argsort(-odds[good], kind="stable")][:LEXICON_SIZE]
    keys = counted["key"].to_numpy(np.int64).view(np.uint64)[good]
    order = np.argsort(keys)
    return Lexicon(keys[order], odds[good][order])


def text_features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    size = len(offsets) - 1
    words = Words(data, offsets, _LETTERS)
    count = np.diff(words.first)
    per_word, length = np.maximum(count, 1), np.maximum(np.diff(offsets), 1)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, values, size)

    def most(values: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        np.maximum.at(out, words.text[values > 0], values[values > 0])
        return out

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / length

    exact = lexicon.weigh(words.hash)
    begun = np.max([lexicon.weigh(_prefix_hashes(words, s)) for s in PREFIXES], 0)
    read = Words(_READ[data], offsets, _WITH_SIGNS)
    bad = (lexicon.weigh(read.hash) > 0) | (_present(_LISTED, read.hash) >= 0)
    hidden = np.bincount(read.text, bad, size)
    listed = _present(_LISTED, words.hash) >= 0

    person = _present(_PERSON, words.hash) >= 0
    hit = np.flatnonzero((exact > 0) | (begun > 0) | listed)
    near = np.zeros(len(words.hash))
    if len(hit) and person.any():
        at = np.flatnonzero(person)
        for side in (0, 1):
            place = np.clip(np.searchsorted(at, hit) - side, 0, len(at) - 1)
            same = words.text[at[place]] == words.text[hit]
            closeness = 1 / (1 + np.abs(at[place] - hit))
            near[hit] = np.maximum(near[hit], np.where(same, closeness, 0))

    def inside(table: np.ndarray) -> np.ndarray:
        """Bytes of each word that the table has."""
        sums = np.concatenate([[0], np.cumsum(table[data])]) if len(data) else np.zeros(2, int)
        return sums[words.end] - sums[words.start]

    long = words.end - words.start
    digits, upper, letters = inside(_DIGITS), inside(_UPPER), inside(_ALPHA)
    repeats = np.zeros(len(data) + 1, int)
    if len(data) > 2:
        thrice = (words.data[2:] == words.data[1:-1]) & (words.data[1:-1] == words.data[:-2])
        repeats[3:] = np.cumsum(thrice & _ALPHA[words.data[2:]])
    stretched = repeats[words.end] - repeats[np.minimum(words.start + 2, words.end)] > 0
    columns = [
        total(exact > 0), total(exact > 0) / per_word, most(exact), total(exact) / per_word,
        total(begun > 0), total(begun > 0) / per_word, most(begun),
        np.maximum(hidden - total((exact > 0) | listed), 0),
        total(listed), total(listed) / per_word, most(near), total(near) / per_word,
        total(person) / per_word, share(_UPPER), total((upper == long) & (long > 1)) / per_word,
        share(_MARKS), share(_PUNCTUATION), share(_DIGITS), total(long == 1) / per_word,
        total((digits > 0) & (letters > 0)) / per_word, total(stretched) / per_word,
        np.log1p(count),
    ]
    return np.stack(columns, 1)


_PERSON, _LISTED = _hashes_of(SECOND_PERSON), _hashes_of(LISTED)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    calibrate: Isotonic

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.calibrate(self.trees.decide(text_features(data, offsets, self.lexicon)))


def fit(documents: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> ToxicityModel:
    """Learns from ``labels`` (doc_id, label 0/1), about ``limit`` rows of them.

    The sample has two halves. Each half's features come from the lexicon of the
    other, so that the trees see words as new texts show them. Scores are calibrated on
    all rows, each scored by trees that have not learned from it; the trees that are
    kept have learned from all.
    """
    one_label = (
        labels.where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
    )
    drawn = sample_of(one_label, "doc_id", limit)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2 * FOLDS)).cast("int")
    part, fold = draw % 2, F.floor(draw / 2).cast("int")
    labelled = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    sample = stored(
        labelled.select(
            "text", F.col("label").cast("int").alias("label"), part.alias("part"), fold.alias("fold")
        ),
        "toxicity-sample",
    )
    schema = "key long, n0 long, n1 long, n2 long, n3 long"
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]
    counted = (
        map_arrow(sample, _count_entries, schema)
        .groupBy("key")
        .agg(*sums)
        .where("n1 + n3 >= 2 and (n1 + n3) * 3 >= n0 + n2")
        .toPandas()
    )
    sizes = np.zeros(4)
    for row in sample.groupBy("part", "label").count().collect():
        sizes[2 * row[0] + row[1]] = row[2]
    first, second, both = (_lexicon(counted, sizes, p) for p in ((0,), (1,), (0, 1)))
    del counted
    lexicons = (second, first)

    def features(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            parts = rows.column("part").to_numpy(zero_copy_only=False)
            x = np.zeros((rows.num_rows, len(FEATURES)))
            for p, lexicon in enumerate(lexicons):
                if (parts == p).any():
                    x[parts == p] = text_features(data, offsets, lexicon)[parts == p]
            yield pa.RecordBatch.from_pydict(
                {
                    "x": pa.array([row.astype("<f8").tobytes() for row in x], pa.binary()),
                    "label": rows.column("label"),
                    "fold": rows.column("fold"),
                }
            )

    found = map_arrow(sample, features, "x binary, label int, fold int").toArrow()
    y = found["label"].to_numpy().astype(float)
    fold = found["fold"].to_numpy()
    x = np.frombuffer(b"".join(found["x"].to_pylist()), "<f8").reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, y, fold))  # the rows' order must not matter
    x, y, fold = x[order], y[order], fold[order]
    unseen = np.zeros(len(y))
    for f in range(FOLDS):
        unseen[fold == f] = BoostedTrees().fit(x[fold != f], y[fold != f]).decide(x[fold == f])
    return ToxicityModel(both, BoostedTrees().fit(x, y), Isotonic().fit(unseen, y))


def score(documents: DataFrame, model: ToxicityModel, column: str = "toxicity") -> DataFrame:
    """The documents, all their columns, with a score from 0 to 1 in ``column``, which
    replaces an input column of that name."""
    documents = documents.drop(column)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select("*", F.lit(0.0).alias(column)).schema

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            found = pa.array(sent.value.score(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, found], names=[*rows.schema.names, column]
            )

    return map_arrow(documents, run, schema)
