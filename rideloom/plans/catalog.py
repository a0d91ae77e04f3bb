"""Register of the queries: name -> (Spark query, SQL with the same answer)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.plans.tables import Tables
from rideloom.session import prepare


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return document_form(self.build(Tables(prepare(spark), sf_dir)))


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function under ``name``."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in CATALOG:
            raise ValueError(f"query {name!r} is registered twice")
        CATALOG[name] = Query(build, sql)
        return build

    return register


def document_form(df: DataFrame) -> DataFrame:
    """Dates and times as text, the way result documents carry them."""
    formats = {"date": "yyyy-MM-dd", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    return df.select(*[
        F.date_format(name, formats[kind]).alias(name) if kind in formats else F.col(name) for name, kind in df.dtypes
    ])


def r6(column, digits: int = 6):
    """A double rounded for output, so that the order of additions does not show."""
    col = F.col(column) if isinstance(column, str) else column
    out = F.round(col, digits)
    return out.alias(column) if isinstance(column, str) else out
