"""Columns that are evaluated exactly once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read instead of repeating their expressions.

    A filter on an ordinary computed column moves below it with a copy of the whole expression, once
    per mention. Passing the columns through a generator of one row keeps them as plain values; the
    generator stays inside the generated code of the stage.
    """
    row = F.struct(*[col.alias(name) for name, col in columns.items()])
    return df.select("*", F.inline(F.array(row)))
