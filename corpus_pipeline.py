"""The corpus pipeline: toxicity, near duplicates, contamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. ``run`` writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.llm import decontam, neardup, secret_scan, toxicity
from callpulse.llm.common import stored, table
from callpulse.llm.queries import packed_pieces, toxicity_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Score from which a document is toxic.
TOXIC = 0.7


def _bundled(docs: DataFrame) -> DataFrame:
    """All columns but the text as one, so that none clashes with an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("rest"), "text")


def _unbundled(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(
        *(
            F.col("text") if c == "text" else F.col("rest").getField(c).alias(c)
            for c in docs.columns
        )
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. The model learns from the labels and
    texts of the given tables."""
    scored = toxicity.score(_bundled(docs), toxicity_model(spark, sf_dir), "toxicity")
    return _unbundled(scored.where(F.col("toxicity") < TOXIC), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one of least doc_id, and of rows with one doc_id and one
    text one row. Documents without words stay, and so do rows without doc_id."""
    linked = neardup.linked_documents(docs)
    gone = linked.where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
    # Rows of one doc_id are rare, so only they are compared by their texts.
    again = stored(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return kept
    single = kept.join(again, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
    repeated = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    marked = decontam.contamination(_bundled(docs), table(spark, sf_dir, "benchmark"))
    return _unbundled(marked.where(F.size("hits") == 0), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars counted anew
    where that changed the text."""
    redacted = secret_scan.find(_bundled(docs), secret_scan.fit(docs), redact=True)
    if "n_chars" in docs.columns:
        counted = F.when(F.size("findings") > 0, F.char_length("text")).otherwise(
            F.col("rest.n_chars")
        )
        kind = docs.schema["n_chars"].dataType
        redacted = redacted.withColumn(
            "rest", F.col("rest").withField("n_chars", counted.cast(kind))
        )
    return _unbundled(redacted, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence."""
    return packed_pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# The trained and hashed stages have no SQL; the tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
