"""Columns that are evaluated once per row, however often they are used."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns`` so that later filters and projections read their results.

    Catalyst moves a filter below a projection by copying the projection's
    expressions into it, so a parsed field would be parsed again for every use.
    A one-row generator gives the same columns and is not copied. It is compiled
    into the surrounding stage and shuffles nothing.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))
