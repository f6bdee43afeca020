"""The operators as named queries over the tables of a folder.

Each applies its operator to the whole table and derives the columns that the
comparison with other engines needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.llm import (
    decontam,
    hard_negatives,
    langid,
    license_scan,
    neardup,
    packing,
    preference,
    quality,
    quality_rules,
    secret_scan,
    spelling,
    topk,
    toxicity,
)
from callpulse.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _named(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _labels(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """The labels that may be learned from: two of three folds."""
    labels = table(spark, folder, "labels").where(fold("doc_id", 3) != 1)
    return labels.select(F.col("doc_id").cast("long"), F.col(column).alias("label"))


def _documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select(*(columns or ("doc_id", "text")))


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.ToxicityModel:
    return toxicity.fit(_documents(spark, folder), _labels(spark, folder, "toxic"))


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def packed_pieces(documents: DataFrame) -> DataFrame:
    """Pieces and their places, with the checksum of their ids in the ids' stead."""
    pieces = packing.tokenized(documents)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@_named
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The unlabelled texts learned from are those of the learning folds as well."""
    documents = _documents(spark, folder)
    taught = documents.where(fold("doc_id", 3) != 1)
    model = quality.fit(taught, _labels(spark, folder, "quality"))
    return _scored(quality.score(documents, model, "score"), threshold=0.5)


@_named
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(_documents(spark, folder))


@_named
def op3_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.linked_documents(_documents(spark, folder))


@_named
def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    found = secret_scan.find(documents, secret_scan.fit(documents))

    def counted(kind: str):
        ours = F.filter("findings", lambda f: f["kind"] == kind)
        return F.size(ours).cast("long").alias(f"n_{kind}")

    def joined(findings):
        return F.concat_ws(
            ",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"]))
        )

    base = F.filter("findings", lambda f: f["kind"] != "model")
    return found.select(
        "doc_id",
        *(counted(kind) for kind in ("assign", "access", "hex")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


@_named
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontam.contamination(_documents(spark, folder), table(spark, folder, "benchmark"))
    n_hit = F.aggregate(
        "hits", F.lit(0).cast("long"), lambda all, run: all + run["end"] - run["start"]
    )
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_named
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    scores = toxicity.score(documents, toxicity_model(spark, folder), "score")
    return _scored(scores, threshold=0.7)


@_named
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = preference.conversations_of(table(spark, folder, "conversations"))
    pairs = preference.formatted(preference.against_repetition(conversations))

    def spelled(spans: str):
        ends = F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"]))
        return F.concat_ws(",", ends).alias(spans)

    return pairs.select(
        "conv_id",
        "prefix_turns",
        F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen", 256).alias("chosen_sha256"),
        spelled("chosen_spans"),
        F.sha2("rejected", 256).alias("rejected_sha256"),
        spelled("rejected_spans"),
    )


@_named
def op8_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    found = license_scan.scan(documents, license_scan.fit(documents))
    families = F.array_sort(F.array_distinct(F.col("licenses.family")))
    spans = F.transform(
        "licenses", lambda f: F.concat_ws(":", f["family"], f["start"], f["end"])
    )
    return found.select(
        "doc_id",
        F.col("paragraphs").alias("n_paragraphs"),
        F.size("licenses").cast("long").alias("n_licensed"),
        F.concat_ws(",", families).alias("families"),
        F.concat_ws(",", spans).alias("spans"),
    )


@_named
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder, "doc_id", "text", "lang")
    model = langid.fit(documents.where(fold("doc_id", 4) != 2))
    return langid.identify(documents.select("doc_id", "text"), model).select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


@_named
def op10_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


@_named
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh row has a label that is not its own, as mislabelled rows would."""
    label = F.col("label").cast("long")
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        "embedding",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
    )
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


@_named
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """One occurrence in 31 loses a letter, as misspelt ones would."""
    found = spelling.runs(_documents(spark, folder), 7, "doc_id")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "word")
    hashed = found.withColumn("h", F.crc32(name.cast("binary")))
    short = spelling.without_letter("word", F.col("h") % F.char_length("word"))
    words = hashed.select(F.when(F.col("h") % 31 == 0, short).otherwise(F.col("word")).alias("word"))
    return spelling.variants(spelling.vocabulary(words, least_letters=7, least_count=2))


@_named
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of few words, or mostly of repeated ones, fail whatever was learned."""
    documents = _documents(spark, folder)
    words, repeated = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    failed = (words < 20) | (100 * repeated > 30 * words)
    rules = quality_rules.fit(documents, _labels(spark, folder, "quality"), among=~failed)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules.judged(documents, rules).select(
        "doc_id",
        *(f"counts.{name}" for name in base),
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
        "rejected_by",
    )
