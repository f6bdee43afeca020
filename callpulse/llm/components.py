"""Connected components of a table of links, by minimum labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """The smallest id each linked id can reach: (id, component).

    ``links`` has long columns ``a`` and ``b``. Each round every id takes the
    least label among itself and its neighbours, and then its label's label, so
    chains shorten by halves. Labels are a stored table; only a count of changed
    ids comes to the driver. A node of any number of links is aggregated in
    parts before it moves.
    """
    both = stored(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(),
        "links",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "id").select(
            "id",
            F.col("component").alias("before"),
            F.least("component", "near").alias("component"),
        )
        lowered = stored(lowered, "labels")
        roots = lowered.select(F.col("id").alias("component"), F.col("component").alias("root"))
        labels = stored(
            lowered.join(roots, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component"), "before"
            ),
            "labels",
        )
        if labels.where("component <> before").isEmpty():
            return labels.select("id", "component")
