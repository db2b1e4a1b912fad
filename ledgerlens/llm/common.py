"""What the operators share: typed empty values, scratch tables, row-wise text functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_dir


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later steps start from files
    that every executor can read again, whatever executors are lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def per_text(
    function: Callable[[], Callable[[str | None], tuple]], schema: str, once: bool = False
) -> Callable[[Column], Column]:
    """A column function: one struct per text.

    ``function`` builds the per-text helper once per task, so tables it needs are set up
    there and not per row. A null text reaches the helper as None. ``once``: a filter on the
    result does not have it computed a second time, by a Python worker of its own.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def over(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = function()
        for series in texts:
            yield pd.DataFrame([one(text) for text in series.to_numpy()], columns=names)

    # Typed names only: the schema text is parsed when a session exists.
    over.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}

    def column(text: Column) -> Column:
        udf = F.pandas_udf(over, schema)
        return (udf.asNondeterministic() if once else udf)(text)

    return column


def unused(columns: Iterable[str], stem: str) -> str:
    """A column name that no input column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while stem in taken:
        stem += "_"
    return stem
