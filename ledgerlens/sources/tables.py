"""Report tables on disk: dated CSV scans and the sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.text import dayfirst_ts


def read_dated_csv(
    spark: SparkSession, path: str, schema: T.StructType, date_column: str, dayfirst: bool = False
) -> DataFrame:
    """CSV with ``date_column`` read as a date; bad dates become NULL, a missing file an empty table."""
    text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == date_column else f.dataType) for f in schema]
    )
    column = F.col(f"`{date_column}`")
    parsed = dayfirst_ts(column) if dayfirst else column.try_cast("timestamp_ntz")
    try:
        raw = spark.read.schema(text).option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], text)
    return raw.withColumn(date_column, parsed.cast("date"))


def write_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Write one report table. ``single_file`` is for tables bounded by the calendar or by labels."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        writer.format(fmt).save(path)
