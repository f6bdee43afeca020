"""Language identification with a blended-spectrum string kernel.

A text's feature set is which byte n-grams of one to three bytes it holds, once
each, in a table of fixed size; the kernel of two texts is the number of entries
both hold, over the root of the product of their numbers. Nystroem's method
replaces the kernel by its values at landmark texts, and one-versus-rest kernel
ridge regression is solved on them. Since the kernel is an inner product, the
solution folds into one matrix of entries by languages: scoring is the product of
a batch of presence rows with it.

Null texts and texts without a letter are ``und``. Rows without doc_id are
scored like others. Without labelled rows every text is ``und``. Ties go to the
language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import bytes_where, fold_case, map_arrow, stored, text_blocks
from callpulse.llm.learning import sample_of

#: Labelled texts learned from, and landmarks among them, at most (about).
LABELLED_ROWS, LANDMARKS = 6_000, 256
SIZES = (1, 2, 3)
ENTRIES = 1 << 16
RIDGE = 1e-3
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = bytes_where(lambda b: b < 128 and chr(b).isalpha())


def _entries(data: np.ndarray) -> np.ndarray:
    """The table entry of every n-gram of the bytes."""
    code = np.zeros(len(data), np.uint32)
    found = []
    for size in range(1, max(SIZES) + 1):
        code = (code[: max(len(data) - size + 1, 0)] << np.uint32(8)) | data[size - 1 :]
        if size in SIZES:
            spread = (code + np.uint32(size << 28)) * np.uint32(0x9E3779B1)
            found.append(spread >> np.uint32(16))
    return np.concatenate(found)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of flags for each text."""
    data = fold_case(data)
    out = np.zeros((len(offsets) - 1, ENTRIES), bool)
    for row, (first, last) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        out[row, _entries(data[first:last])] = True
    return out


def has_letter(data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    for row in np.flatnonzero(~out):
        text = texts[int(row)].as_py()
        out[row] = bool(text) and _LETTER.search(text) is not None
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    matrix: np.ndarray  # entries by languages

    def decide(self, flags: np.ndarray) -> np.ndarray:
        """The regression's value for each row and language."""
        rows, entries = np.nonzero(flags)
        begin = np.searchsorted(rows, np.arange(len(flags)))
        sizes = np.diff(np.append(begin, len(rows)))
        out = np.zeros((len(flags), self.matrix.shape[1]))
        full = np.flatnonzero(sizes)
        if len(full):
            out[full] = np.add.reduceat(self.matrix[entries], begin[full], axis=0)
            out[full] /= np.sqrt(sizes[full])[:, None]
        return out


_ROWS = 64


def _in_rows(data: np.ndarray, offsets: np.ndarray):
    """Parts of a block whose flags fit in a few megabytes."""
    for first in range(0, len(offsets) - 1, _ROWS):
        own = offsets[first : first + _ROWS + 1]
        yield first, first + len(own) - 1, data[own[0] : own[-1]], own - own[0]


def _packed(batches):
    """The flags of each text, eight to a byte."""
    for rows, data, offsets in text_blocks(batches, "text"):
        for first, last, part, own in _in_rows(data, offsets):
            flags = [row.tobytes() for row in np.packbits(presence(part, own), axis=1)]
            keys = rows.column("key").slice(first, last - first)
            yield pa.RecordBatch.from_arrays([keys, pa.array(flags, pa.binary())], names=["key", "flags"])


def _nystroem(landmarks):
    """Kernel values of each text with the landmarks."""

    def run(batches):
        flags, sizes = landmarks.value
        for rows, data, offsets in text_blocks(batches, "text"):
            for first, last, part, own in _in_rows(data, offsets):
                here = presence(part, own).astype(np.float32)
                common = here @ flags.T.astype(np.float32)
                kernel = common / np.sqrt(np.maximum(here.sum(1), 1)[:, None] * sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("lang").slice(first, last - first),
                        pa.array([k.astype("<f4").tobytes() for k in kernel], pa.binary()),
                    ],
                    names=["lang", "kernel"],
                )

    return run


def fit(documents: DataFrame, limit: int = LABELLED_ROWS, landmarks: int = LANDMARKS) -> LanguageModel:
    """Learns from ``documents`` (doc_id, text, lang), about ``limit`` rows of them."""
    spark = documents.sparkSession
    usable = documents.where("lang is not null and text is not null").select(
        F.col("doc_id").cast("long"), "text", "lang"
    )
    sample = stored(sample_of(usable, "doc_id", limit), "language-sample")
    # The landmarks are drawn by hash first, so that only their flags come here.
    hashed = F.xxhash64("doc_id", "text", F.lit(13)).alias("key")
    keyed = sample.where("text <> ''").select(hashed, "text")
    drawn = [r.key for r in keyed.select("key").distinct().orderBy("key").limit(landmarks).collect()]
    if not drawn:
        return LanguageModel([], np.zeros((ENTRIES, 0), np.float32))
    packed = map_arrow(keyed.where(F.col("key").isin(drawn)), _packed, "key long, flags binary")
    by_key = {r.key: bytes(r.flags) for r in packed.distinct().collect()}
    bits = np.frombuffer(b"".join(by_key[key] for key in drawn), np.uint8)
    flags = np.unpackbits(bits.reshape(len(drawn), -1), axis=1).astype(bool)
    sizes = flags.sum(1).astype(np.float64)
    sent = spark.sparkContext.broadcast((flags, sizes))
    found = map_arrow(sample, _nystroem(sent), "lang string, kernel binary").toArrow()
    x = np.frombuffer(b"".join(found["kernel"].to_pylist()), "<f4").reshape(-1, len(drawn)).astype(float)
    names = np.array(found["lang"].to_pylist())
    order = np.lexsort((*x.T[:4], names))  # the rows' order must not matter
    x, names = x[order], names[order]
    languages = sorted(set(names.tolist()))
    target = np.where(names[:, None] == np.array(languages), 1.0, -1.0)
    # Each language's texts weigh as much as all others together.
    dense = flags.astype(np.float32)
    between = (dense @ dense.T).astype(float) / np.sqrt(np.outer(sizes, sizes))
    columns = []
    for k in range(len(languages)):
        ones = max((target[:, k] > 0).sum(), 1)
        weight = np.where(target[:, k] > 0, 0.5 / ones, 0.5 / max(len(names) - ones, 1))
        system = (x * weight[:, None]).T @ x + RIDGE * between + 1e-9 * np.eye(len(drawn))
        columns.append(np.linalg.solve(system, (x * weight[:, None]).T @ target[:, k]))
    alpha = np.stack(columns, 1) / np.sqrt(sizes)[:, None]
    return LanguageModel(languages, (dense.T @ alpha.astype(np.float32)).astype(np.float32))


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents, all their columns, with ``lang_pred`` and ``lang_score``: the
    share of the best language among the softmax of the values. Input columns of
    these names are replaced."""
    documents = documents.drop("lang_pred", "lang_score")
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select(
        "*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("lang_score")
    ).schema

    def run(batches):
        for rows, data, offsets in text_blocks(batches, "text"):
            own, size = sent.value, len(offsets) - 1
            best, score = np.full(size, -1), np.ones(size)
            letters = has_letter(data, offsets, rows.column("text"))
            if own.languages:
                for first, last, part, places in _in_rows(data, offsets):
                    value = own.decide(presence(part, places))
                    best[first:last] = value.argmax(1)
                    share = np.exp(4 * (value - value.max(1, keepdims=True)))
                    score[first:last] = 1 / share.sum(1)
            best[~letters] = -1
            names = [own.languages[k] if k >= 0 else UNKNOWN for k in best]
            score[best < 0] = 1.0
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(names, pa.string()), pa.array(score)],
                names=[*rows.schema.names, "lang_pred", "lang_score"],
            )

    return map_arrow(documents, run, schema)
