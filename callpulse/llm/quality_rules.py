"""Quality rules: a decision list learned from labelled statistics of texts.

Per text Spark tasks count words, characters, lines and repeats; rates of these counts
are Spark expressions. Sequential covering learns from labelled rates: a rule is grown
condition by condition on one part of the rows (FOIL's gain), its last conditions are
pruned on the other, the rows it covers go, and the next rule is learned from the rest.
Learning ends with the first rule that is not precise on the pruning part. The list
becomes one conditional expression: the first rule that holds rejects the text, and a
text that no rule holds for is kept.

A null, empty or wordless text has all counts 0 and all rates 0. Without labels of both
kinds the list is empty and keeps everything. Equal rows get equal verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import Words, bytes_where, map_arrow, mix, stored, text_blocks
from callpulse.llm.learning import sample_of

#: Labelled rows that are learned from, at most (about): the default of ``fit``.
LABELLED_ROWS = 16_000
#: Words of a window whose repetition is counted.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

COUNTS = """n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct_words
n_capitals n_letters n_digits n_marks longest_word""".split()

_BLANK = bytes_where(lambda b: b == 32 or 9 <= b <= 13)
_LINE = bytes_where(lambda b: b != 10)
_CLASSES = {
    "word_chars": bytes_where(lambda b: not _BLANK[b] and b & 0xC0 != 0x80),
    "n_symbols": bytes_where(lambda b: b in SYMBOLS),
    "n_capitals": bytes_where(lambda b: 65 <= b <= 90),
    "n_letters": bytes_where(lambda b: chr(b).isalpha() and b < 128 or b >= 0xC0),
    "n_digits": bytes_where(lambda b: 48 <= b <= 57),
    "n_marks": bytes_where(lambda b: b in b"!?"),
}


def _keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One 64-bit key for each hash and text."""
    return mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)))


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text of a block. Words, lines and windows are compared by
    64-bit hashes."""
    size = len(offsets) - 1
    words = Words(data, offsets, ~_BLANK, folded=False)
    lines = Words(data, offsets, _LINE, folded=False)

    def within(table: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])]).astype(np.int64)
        return sums[end] - sums[start]

    found = {name: within(table, offsets[:-1], offsets[1:]) for name, table in _CLASSES.items()}
    found["n_words"] = np.diff(words.first)
    if not len(words.start):
        return {name: found.get(name, np.zeros(size, np.int64)) for name in COUNTS}
    first_of = np.unique(_keys(words.hash, words.text), return_index=True)[1]
    found["n_distinct_words"] = np.bincount(words.text[first_of], minlength=size)
    found["longest_word"] = np.zeros(size, np.int64)
    np.maximum.at(
        found["longest_word"], words.text, within(_CLASSES["word_chars"], words.start, words.end)
    )

    worded = within(_CLASSES["word_chars"], lines.start, lines.end) > 0
    line_text, line_hash = lines.text[worded], lines.hash[worded]
    first_of = np.unique(_keys(line_hash, line_text), return_index=True)[1]
    found["n_lines"] = np.bincount(line_text, minlength=size)
    found["n_dup_lines"] = found["n_lines"] - np.bincount(line_text[first_of], minlength=size)

    covered = np.zeros(len(words.hash) + 1, np.int64)
    windows, whole = words.grams(WINDOW)
    at = np.flatnonzero(whole)
    if len(at):
        _, place, often = np.unique(
            _keys(windows[at], words.text[at]), return_inverse=True, return_counts=True
        )
        again = at[often[place] > 1]
        covered[again] += 1
        covered[again + WINDOW] -= 1
    inside = np.cumsum(covered)[:-1] > 0
    found["n_repeat_words"] = np.bincount(words.text[inside], minlength=size)
    return {name: found[name] for name in COUNTS}


def with_counts(documents: DataFrame, column: str = "counts") -> DataFrame:
    """The documents, all their columns, with a struct of ``COUNTS``, which replaces an
    input column of that name."""
    documents = documents.drop(column)
    zeros = F.struct(*(F.lit(0).cast("long").alias(name) for name in COUNTS))
    schema = documents.select("*", zeros.alias(column)).schema

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            found = counts(data, offsets)
            struct = pa.StructArray.from_arrays(
                [pa.array(found[name], pa.int64()) for name in COUNTS], names=COUNTS
            )
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, struct], names=[*rows.schema.names, column]
            )

    return map_arrow(documents, run, schema)


#: What conditions are about: a count, or its share of another.
RATES = {
    "words": ("n_words", None),
    "longest_word": ("longest_word", None),
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "capital_share": ("n_capitals", "n_letters"),
    "letter_share": ("n_letters", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "n_words"),
}
_PLACE = {name: place for place, name in enumerate(RATES)}


def rates(column: str = "counts") -> dict[str, Column]:
    """``RATES`` of the struct of counts; shares of nothing are 0."""

    def rate(part: str, whole: str | None) -> Column:
        count = F.col(f"`{column}`.{part}").cast("double")
        if whole is None:
            return count
        of = F.col(f"`{column}`.{whole}")
        return F.when(of > 0, count / of).otherwise(0.0)

    return {name: rate(*of) for name, of in RATES.items()}


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, _PLACE[self.rate]]
        return values > self.threshold if self.above else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.rate} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """All conditions hold; of the pruning part's rows it covers, this share is bad."""

    conditions: tuple[Condition, ...]
    precision: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for condition in self.conditions:
            out &= condition.holds(x)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def first_rule(self, x: np.ndarray) -> np.ndarray:
        """The place of the first rule that holds for each row of rates, or -1."""
        out = np.full(len(x), -1)
        for place in reversed(range(len(self.rules))):
            out[self.rules[place].holds(x)] = place
        return out

    def expression(self, column: str = "counts") -> Column:
        """The rule that rejects the text, in words; null for a text that is kept."""
        found, chain = rates(column), F
        for rule in self.rules:
            holds = F.lit(True)
            for c in rule.conditions:
                bound = F.lit(c.threshold)
                holds &= found[c.rate] > bound if c.above else found[c.rate] <= bound
            chain = chain.when(holds, F.lit(str(rule)))
        return F.lit(None).cast("string") if chain is F else chain


class Covering:
    """Sequential covering: ``x`` are rates, ``y`` is true for texts to reject."""

    def __init__(self, bins: int = 64, most_conditions: int = 4, precision: float = 0.9, least: int = 3):
        self.bins, self.most_conditions = bins, most_conditions
        self.precision, self.least = precision, least

    def fit(self, x: np.ndarray, y: np.ndarray, pruning: np.ndarray) -> DecisionList:
        rules: list[Rule] = []
        left = np.ones(len(x), bool)
        candidates = self._candidates(x[~pruning])
        while (y & left & ~pruning).sum() >= self.least:
            grown = self._grow(x, y, left & ~pruning, candidates)
            rule = self._prune(grown, x, y, left & pruning)
            covered = rule.holds(x) & left
            if not rule.conditions or rule.precision < self.precision or not (covered & y).any():
                break
            rules.append(rule)
            left &= ~covered
        return DecisionList(rules)

    def _candidates(self, x: np.ndarray) -> list[Condition]:
        """Thresholds halfway between neighbouring quantiles, so that they lie between
        values that occur."""
        found = []
        for name, values in zip(RATES, x.T):
            levels = np.unique(np.quantile(values, np.linspace(0, 1, self.bins + 1))) if len(values) else []
            for low, high in zip(levels[:-1], levels[1:]):
                found += [Condition(name, above, float((low + high) / 2)) for above in (True, False)]
        return found

    def _grow(self, x, y, rows, candidates) -> Rule:
        covered, conditions = rows, ()
        while len(conditions) < self.most_conditions and (covered & ~y).any():
            p, n = (covered & y).sum(), (covered & ~y).sum()
            best, gain = None, 0.0
            for condition in candidates:
                held = covered & condition.holds(x)
                p1, n1 = (held & y).sum(), (held & ~y).sum()
                if p1 < self.least:
                    continue
                gained = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                if gained > gain + 1e-9:
                    best, gain = condition, gained
            if best is None:
                break
            conditions += (best,)
            covered = covered & best.holds(x)
        return Rule(conditions)

    def _prune(self, rule: Rule, x, y, rows) -> Rule:
        """The beginning of the rule that is most precise on ``rows``, the shortest of
        equals. To choose, two rows more count, one of each kind. No conditions are left
        if too few rows bear the rule out."""
        best, most = Rule(()), 0.0
        for length in range(1, len(rule.conditions) + 1):
            begun = Rule(rule.conditions[:length])
            held = begun.holds(x) & rows
            bad = (held & y).sum()
            precise = (bad + 1) / (held.sum() + 2)
            if bad >= self.least and precise > most + 1e-9:
                best, most = Rule(begun.conditions, float(bad / held.sum())), precise
        return best


def fit(
    documents: DataFrame,
    labels: DataFrame,
    limit: int = LABELLED_ROWS,
    among: Column | None = None,
    covering: Covering | None = None,
) -> DecisionList:
    """Learns from ``labels`` (doc_id, label 0 for texts to reject, 1 for others), about
    ``limit`` rows of them. Null labels and ids with both labels teach nothing, nor do
    texts without ``among``, a condition on ``counts``: for those that are rejected
    anyhow."""
    one_label = (
        labels.where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
    )
    drawn = sample_of(one_label, "doc_id", limit).select("doc_id", "label")
    pruning = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(3)) == 0
    labelled = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    counted = with_counts(labelled.select("text", "label", pruning.alias("pruning")))
    counted = counted if among is None else counted.where(among)
    rows = stored(
        counted.select("label", "pruning", F.array(*rates().values()).alias("x")), "quality-rates"
    ).toArrow().combine_chunks()
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(RATES))
    y = rows["label"].to_numpy() == 0
    part = rows["pruning"].to_numpy()
    order = np.lexsort((*x.T, y, part))  # the rows' order must not matter
    return (covering or Covering()).fit(x[order], y[order], part[order])


def judged(
    documents: DataFrame, rules: DecisionList, column: str = "rejected_by", counts: str = "counts"
) -> DataFrame:
    """The documents with their counts, and in ``column`` the rule that rejects the
    text (null: kept). Input columns of these names are replaced."""
    counted = with_counts(documents.drop(column), counts)
    return counted.withColumn(column, rules.expression(counts))
