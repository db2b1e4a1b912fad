"""Daily loads over event time as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.rules import Rules
from ledgerlens.operators.classify import classify
from ledgerlens.operators.common import cents_sum, counted, exact, to_money, with_keys


_DAY = 86_400


def _instant(ts: Column) -> Column:
    """The wall-clock time as an instant, read as UTC whatever the session's zone.

    Watermarks need an instant; ledger times have no zone.
    """
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.timestamp_seconds(F.unix_date(F.to_date(ts)).cast("bigint") * _DAY + seconds)


def daily_loads(ledger_stream: DataFrame, rules: Rules = Rules(), lateness: str = "2 days") -> DataFrame:
    """Loads per day and channel; distinct users are estimated, as streams cannot count them exactly."""
    timed = ledger_stream.withColumn("event_time", _instant(F.col("ts")))
    start = F.unix_seconds("window.start")
    return (
        classify(timed.withWatermark("event_time", lateness), rules)
        .where("is_load")
        .groupBy(F.window("event_time", "1 day").alias("window"), "channel")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("Recargas"),
            F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("Monto"),
            F.approx_count_distinct("doc_id").alias("Usuarios_Aprox"),
        )
        .select(
            F.date_from_unix_date((start / _DAY).cast("int")).alias("Fecha_Dia"),
            F.col("channel").alias("Canal"),
            "Recargas",
            "Monto",
            "Usuarios_Aprox",
        )
    )


def write_daily_loads(loads: DataFrame, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store every update of a day under its batch number, so a repeated batch overwrites itself."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        loads.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_daily_loads(spark: SparkSession, target: str) -> DataFrame:
    """The latest state of every day and channel."""
    columns = ["Recargas", "Monto", "Usuarios_Aprox"]
    return (
        spark.read.parquet(target)
        .groupBy("Fecha_Dia", "Canal")
        .agg(F.max_by(F.struct(*columns), "batch").alias("last"))
        .select("Fecha_Dia", "Canal", *[F.col(f"last.{c}").alias(c) for c in columns])
    )


# Exact tables with late rows

_PER_USER = "channel string, doc_id bigint, n bigint, cents decimal(28,0), batch bigint, day date"
_PER_DAY = "day date, channel string, n bigint, cents decimal(38,0), users bigint, batch bigint"


def _days(spark: SparkSession, target: str) -> DataFrame:
    try:
        return spark.read.schema(_PER_DAY).parquet(f"{target}/days")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PER_DAY)


def write_exact_loads(
    ledger_stream: DataFrame, target: str, checkpoint: str, rules: Rules = Rules(), **trigger
) -> StreamingQuery:
    """Loads per day and channel with exact distinct users, however late their rows come.

    There is no watermark and no state in memory. Beside the table of days stands one of
    users per day, in folders by day. A batch reduces its loads to a row per day, channel and
    user, merges them with the users of the days it touches, and writes these days anew under
    its number: a late row is a correction of its day, and other days are not read. The rows
    of a day in ``days`` make its version current, so a batch that was lost half way is simply
    repeated. ``target`` belongs to one checkpoint; each movement is to arrive once.
    """

    def merge(rows: DataFrame, batch_id: int) -> None:
        spark, keys = rows.sparkSession, ["day", "channel", "doc_id"]
        facts = with_keys(classify(rows, rules).where("is_load"), "day")
        staged = f"{target}/staging/batch={batch_id}"
        new = facts.groupBy(*keys).agg(counted().alias("n"), cents_sum().cast("decimal(28,0)").alias("cents"))
        new.write.mode("overwrite").parquet(staged)
        new = spark.read.schema(new.schema).parquet(staged)
        # As many as the calendar has days.
        touched = [r[0] for r in new.select("day").distinct().collect()]
        if not touched:
            return
        held = _days(spark, target).where((F.col("batch") < batch_id) & F.col("day").isin(touched))
        versions = held.groupBy("day").agg(F.max("batch").alias("batch")).collect()
        paths = [f"{target}/users/batch={r['batch']}/day={r['day']}" for r in versions]
        if paths:
            old = spark.read.schema(_PER_USER).option("basePath", f"{target}/users").parquet(*paths)
            new = old.select(new.columns).unionByName(new)
            sums = [F.sum("n").alias("n"), F.sum(exact("cents")).cast("decimal(28,0)").alias("cents")]
            new = new.groupBy(*keys).agg(*sums)
        users = f"{target}/users/batch={batch_id}"
        new.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(users)
        merged = spark.read.schema(_PER_USER).option("basePath", f"{target}/users").parquet(users)
        # A user has one row per day and channel.
        days = merged.groupBy("day", "channel").agg(
            F.sum("n").alias("n"), F.sum(exact("cents")).alias("cents"), F.count("doc_id").alias("users")
        )
        days.write.mode("overwrite").parquet(f"{target}/days/batch={batch_id}")

    return (
        ledger_stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_exact_loads(spark: SparkSession, target: str) -> DataFrame:
    """The current table, with the columns of the batch report."""
    last = F.max_by(F.struct("n", "cents", "users"), "batch").alias("last")
    return (
        _days(spark, target)
        .groupBy(F.col("day").alias("Fecha_Dia"), F.col("channel").alias("Canal"))
        .agg(last)
        .select(
            "Fecha_Dia",
            "Canal",
            F.col("last.n").alias("Recargas"),
            to_money(F.col("last.cents")).alias("Monto"),
            F.col("last.users").alias("Usuarios_Unicos"),
        )
    )
