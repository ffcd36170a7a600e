"""Apply a pandas function to slices of a table in parallel."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_chunks(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
) -> DataFrame:
    """``function`` over Arrow batches of each partition; the results are concatenated."""
    def apply(batches):
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(apply, schema)


def map_chunks_with_terms(
    df: DataFrame, function: Callable[[pd.DataFrame], dict[str, set[str]]],
) -> DataFrame:
    """Partial sets per slice, merged by the engine: distinct ``(name, term)``.

    ``function`` returns named sets for a slice; only distinct terms of a slice are sent on.
    """
    def apply(batches):
        for batch in batches:
            pairs = [(name, term) for name, terms in function(batch).items() for term in terms]
            yield pd.DataFrame(pairs, columns=["name", "term"])

    return df.mapInPandas(apply, "name string, term string").distinct()
