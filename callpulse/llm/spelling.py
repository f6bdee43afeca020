"""Spelling variants: words one edit from a far commoner word, by composed automata.

The vocabulary's pairs of words one edit apart are the accepting paths of acceptor,
one-edit transducer and acceptor in composition (``acceptor``). The composition is
spread over partitions of its initial states. A pair of ``size`` letters, or of
``size`` and one more, agrees outside the half of the word that holds its edit. So each
word is sent to its two halves, once as the longer and once as the shorter word of a
pair; what it has outside the half leads to the state that the partition starts in, and
the partition's acceptor reads the half. A partition with more letters than fit one
task is split into those of its quarters, eighths, and so on down to single letters,
where an alphabet bounds it. Every pair belongs to one partition: that with the first
letter in which its words differ.

Words are counted and paired by Spark; a task holds one partition's acceptor. Null and
wordless texts have no words; an empty table gives an empty result; repeated rows count
as often as they stand there.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.llm.acceptor import Acceptor, one_edit_pairs
from callpulse.llm.common import map_arrow, stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters of one partition of initial states, at most, unless they are one position's.
PARTITION_LETTERS = 1 << 17
#: Into how many parts the rows of a partition that must be split are dealt.
SALTS = 32

PAIR = "word string, near string, near_n long"


def runs(documents: DataFrame, least: int, *columns: str) -> DataFrame:
    """Maximal runs of at least ``least`` Latin letters, A-Z in lower case: ``word``,
    beside the given columns."""
    lower = F.translate("text", _UPPER, _UPPER.lower())
    found = F.regexp_extract_all(lower, F.lit(rf"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))
    return documents.select(*columns, F.explode(found).alias("word"))


def without_letter(word: str, place: Column) -> Column:
    """The word without the letter at ``place``, which counts from 0."""
    at = place.cast("int")
    return F.concat(
        F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word))
    )


def vocabulary(words: DataFrame, least_letters: int, least_count: int) -> DataFrame:
    """(word, n): words of so many letters that occur so often."""
    counted = words.where(F.char_length("word") >= least_letters).groupBy("word")
    return counted.agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the partition: what the word has outside the letters ``first`` to ``last``."""
    outside = [
        F.substring("word", F.lit(1), F.col("first")),
        F.substring(
            "word", F.col("last") + F.char_length("word") - F.col("size") + 1, F.char_length("word")
        ),
    ]
    return rows.withColumn("key", F.xxhash64("size", "first", "last", *outside))


def _halved(first: Column, last: Column) -> Column:
    """The two halves of the letters from ``first`` to before ``last``."""
    middle = F.floor((first + last) / 2).cast("int")
    sides = ((first, middle), (middle, last))
    return F.array(*(F.struct(a.alias("first"), b.alias("last")) for a, b in sides))


def _initial_states(words: DataFrame) -> DataFrame:
    """Each word in the partitions of its halves: word, n, size, first, last, key.

    ``size`` is the length of the shorter word of a pair, if the two differ in length.
    """
    length = F.char_length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"))
    halves = sized.select(
        "word", "n", "size", F.inline(_halved(F.lit(0), F.col("size")))
    )
    return _keyed(halves.where("first < last"))


def _fitting(rows: DataFrame, letters: int) -> DataFrame:
    """The rows with partitions of more than ``letters`` letters split until they fit."""
    parts = []
    while True:
        taken = F.sum(F.col("last") - F.col("first"))
        large = stored(
            rows.groupBy("key")
            .agg(F.count("*").alias("words"), taken.alias("letters"), F.max(F.col("last") - F.col("first")).alias("wide"))
            .where((F.col("letters") > letters) & (F.col("words") > 1) & (F.col("wide") > 1))
            .select("key"),
            "large-partitions",
        )
        if large.isEmpty():
            parts.append(rows)
            return functools.reduce(DataFrame.union, parts)
        # A partition may have any share of the words: it is joined in parts.
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("word", F.lit(3)), F.lit(SALTS)).cast("int"))
        copies = large.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("large"))
        marked = stored(salted.join(copies, ["key", "salt"], "left").drop("salt"), "marked-words")
        parts.append(marked.where("large is null").select(rows.columns))
        split = marked.where("large").select("word", "n", "size", F.inline(_halved(F.col("first"), F.col("last"))))
        rows = stored(_keyed(split).select(rows.columns), "split-words")


def pairs_between(group: list[tuple[str, int, int, int, int]]) -> Iterator[tuple]:
    """((word, n), (word, n)): pairs one edit apart in one partition, shorter ones first.

    ``group`` has (word, n, size, first, last). Words of another partition with the same
    hash are kept apart.
    """
    partitions = defaultdict(list)
    for word, n, size, first, last in group:
        end = last + len(word) - size
        partitions[word[:first], word[end:], size, first].append((word[first:end], word, n))
    for (_, _, size, first), rows in partitions.items():
        if len(rows) < 2:
            continue
        rows.sort()
        last = first + min(len(part) for part, _, _ in rows)
        # Of sorted words the first and the last share what all of them share.
        low, high = rows[0][0], rows[-1][0]
        begun = 0
        while begun < len(low) and low[begun] == high[begun]:
            begun += 1
        owners = {part[begun:]: (part, word, n) for part, word, n in rows}
        for short, long in one_edit_pairs(Acceptor(owners)):
            x, y = owners[short], owners[long]
            # Another partition's pair: of two longer words, or first different further on.
            if len(x[1]) > size or last < size and len(short) < len(long) and y[0].startswith(x[0]):
                continue
            yield x[1:], y[1:]


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PAIR``, both ways, from rows sorted by key."""

    def written(found: list[tuple]) -> pa.RecordBatch:
        both = [(x, y, m) for (x, n), (y, m) in found] + [(y, x, n) for (x, n), (y, m) in found]
        columns = list(zip(*both)) or [[], [], []]
        names = {"word": pa.string(), "near": pa.string(), "near_n": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, names.values())], names=list(names)
        )

    key, group, found = None, [], []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "word", "n", "size", "first", "last"))
        for at, *row in zip(*columns):
            if at != key:
                if len(group) > 1:
                    found += pairs_between(group)
                    if len(found) > 4_096:
                        yield written(found)
                        found = []
                key, group = at, []
            group.append(tuple(row))
    if len(group) > 1:
        found += pairs_between(group)
    yield written(found)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of one edit, each from both sides, once.

    ``words`` has (word, n) with each word once."""
    rows = _fitting(_initial_states(words), PARTITION_LETTERS)
    together = rows.repartition("key").sortWithinPartitions("key")
    return map_arrow(together, _paired, PAIR)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by halving chains.

    A form is a given number of times commoner than its word, so that chains are short
    and never closed.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = stored(
            roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        roots = followed.select("word", "root")
        if followed.where("moved").isEmpty():
            return roots


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; once each).

    The form is the near word of largest n (ties: the smallest in code-point order), if
    it occurs at least ``ratio`` times as often as the word, else null. The root follows
    forms to the last; it is the word itself where there is none.
    """
    if ratio < 2:
        raise ValueError("a form must be commoner than its word")
    words = stored(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= ratio * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(common, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
