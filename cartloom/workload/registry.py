"""Registration of queries and the shape their results take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from cartloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shown(function(configure(spark), sf_dir))

        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, means to six places, so that results compare across engines."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            if f.name.startswith("avg_"):
                column = F.round(column, 6)
            column = column.cast("double")
        columns.append(column.alias(f.name))
    return df.select(*columns)
