"""Queries over files: report text derived from the event ledger, read back in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.plans import adapters as A
from ledgerlens.operators import loads, users
from ledgerlens.operators.classify import classify
from ledgerlens.plans.bundle import write_reports
from ledgerlens.plans.refresh import ReportStore
from ledgerlens.schema import REPORT_COLUMNS
from ledgerlens.session import scratch_dir
from ledgerlens.sources.ledger import LedgerStore
from ledgerlens.sources.manifest import list_files, load_manifest, pending_files, save_manifest, upsert_manifest
from ledgerlens.sources.registry import Readings, read_readings
from ledgerlens.sources.reports import read_reports, unique_movements
from ledgerlens.sources.tables import read_dated_csv, write_table

PREAMBLE = ["Reporte de movimientos", "", ";".join(REPORT_COLUMNS)]
LINES_PER_FILE = 10_000


def report_text(ledger: DataFrame, tx_id: str = "CAST(tx_id AS STRING)") -> DataFrame:
    """Report lines of a ledger with es-AR amounts and day-first times."""
    amount = F.translate(F.format_number("amount", 2), ",.", ".,")
    return ledger.select(
        F.concat_ws(
            ";",
            F.coalesce(F.expr(tx_id), F.lit("")),
            F.date_format("ts", "dd/MM/yyyy HH:mm:ss"),
            "movement_type",
            F.col("doc_id").cast("string"),
            F.concat(F.lit('"'), "description", F.lit('"')),
            amount,
        ).alias("value")
    )


def write_report_files(lines: DataFrame, target: str) -> None:
    """Add report files of some ten thousand lines, each with free lines and a header row."""
    files = 1 + lines.count() // LINES_PER_FILE
    whole = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(files)).alias("file")).agg(
        F.collect_list("value").alias("lines")
    )
    text = F.array_join(F.concat(F.array(*map(F.lit, PREAMBLE)), "lines"), "\n")
    whole.select(text.alias("value")).write.mode("append").option("maxRecordsPerFile", 1).text(target)


def _reports(spark: SparkSession, sf_dir: str) -> str:
    target = scratch_dir(spark, "reports")
    write_report_files(report_text(A.event_ledger(spark, sf_dir)), target)
    return target


def ingest_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the generated reports, parsed and unique per transaction."""
    rows = unique_movements(read_reports(spark, _reports(spark, sf_dir), glob="*.txt"))
    return rows.withColumn("amount", F.col("amount").cast("double"))


def ingest_broken_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports whose descriptions break over lines inside quotes, and others, with one stray
    quote among all their rows: each row comes back as it was."""
    ledger = A.event_ledger(spark, sf_dir)
    broken = F.when(F.col("tx_id") % 5 == 0, F.concat("description", F.lit("\nnext; line"))).otherwise(F.col("description"))
    target = scratch_dir(spark, "broken")
    write_report_files(report_text(ledger.where("tx_id % 2 = 0").withColumn("description", broken)), target)
    first = ledger.where("tx_id % 2 = 1").agg(F.min("tx_id").alias("first"))
    odd = ledger.where("tx_id % 2 = 1").crossJoin(F.broadcast(first)).withColumn("stray", F.col("tx_id") == F.col("first"))
    lines = report_text(odd.where("not stray")).unionByName(
        report_text(odd.where("stray")).select(F.concat(F.replace("value", F.lit('"'), F.lit("")), F.lit('"')).alias("value"))
    )
    write_report_files(lines, target)
    rows = unique_movements(read_reports(spark, target, glob="*.txt"))
    return rows.withColumn("amount", F.col("amount").cast("double"))


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger after the same reports came in twice under different names."""
    reports = _reports(spark, sf_dir)
    store = LedgerStore(spark, scratch_dir(spark, "ledger"))
    store.ingest(reports, glob="*.txt")
    write_report_files(report_text(A.event_ledger(spark, sf_dir)), reports)
    store.ingest(reports, glob="*.txt")
    return store.read().withColumn("amount", F.col("amount").cast("double"))


def ingest_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger whose ids are numbers, text or missing, read twice: no row is lost."""
    reports = scratch_dir(spark, "reports")
    ids = "CASE tx_id % 3 WHEN 0 THEN CAST(tx_id AS STRING) WHEN 1 THEN concat('TX-', tx_id) END"
    write_report_files(report_text(A.event_ledger(spark, sf_dir), ids), reports)
    store = LedgerStore(spark, scratch_dir(spark, "ledger"))
    for _ in range(2):
        store.upsert(unique_movements(read_reports(spark, reports, glob="*.txt")))
    key = F.when(~F.startswith("tx_key", F.lit("~")), F.col("tx_key")).alias("tx_key")
    return store.read().select(key, "tx_id", "ts", "doc_id", F.col("amount").cast("double").alias("amount"))


def _movements_in(spark: SparkSession, reports: str, files: DataFrame) -> DataFrame:
    rows = read_reports(spark, reports, glob="*.txt")
    return rows.join(files.select("file_name"), "file_name", "left_semi")


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements in pending files: all at first, none once the manifest holds the files."""
    reports = _reports(spark, sf_dir)
    files = list_files(spark, reports, "*.txt")
    manifest_path = scratch_dir(spark, "manifest")
    before = pending_files(files, load_manifest(spark, manifest_path))
    save_manifest(upsert_manifest(load_manifest(spark, manifest_path), before), manifest_path)
    after = pending_files(files, load_manifest(spark, manifest_path))
    stages = [
        _movements_in(spark, reports, some).agg(F.count("*").alias("movements")).select(
            F.lit(stage).alias("stage"), "movements"
        )
        for stage, some in (("first", before), ("second", after))
    ]
    return stages[0].unionByName(stages[1])


def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements per file state after all files were read again with a later time."""
    reports = _reports(spark, sf_dir)
    files = list_files(spark, reports, "*.txt").select("file_name", "mod_time")
    older = files.withColumn("mod_time", F.col("mod_time") - 60)
    merged = upsert_manifest(older, files)
    rows = read_reports(spark, reports, glob="*.txt").groupBy("file_name").agg(F.count("*").alias("n"))
    current = merged.join(files.withColumn("current", F.lit(True)), ["file_name", "mod_time"], "left")
    return (
        rows.join(current, "file_name")
        .groupBy(F.coalesce("current", F.lit(False)).alias("is_current"))
        .agg(F.sum("n").alias("movements"))
    )


def ingest_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger after files without any header came before and after its reports."""
    bare = scratch_dir(spark, "bare")
    report_text(A.event_ledger(spark, sf_dir)).write.text(bare)
    store = LedgerStore(spark, scratch_dir(spark, "ledger"))
    for folder in (bare, _reports(spark, sf_dir), bare):
        store.ingest(folder, glob="*.txt")
    return store.read().withColumn("amount", F.col("amount").cast("double"))


def dated_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily table written as delimited text and read again by its dates."""
    target = scratch_dir(spark, "dated")
    table = loads.loads_daily_amount_pivot(classify(A.event_ledger(spark, sf_dir), A.EVENT_RULES))
    write_table(table, target, single_file=True)
    return read_dated_csv(spark, target, table.schema, "Fecha_Dia")


OLD_EMAIL = "old@example.com"


def _readings(spark: SparkSession, sf_dir: str) -> Readings:
    """A registry in text that holds every user twice: first with zeros ahead of the id, and
    each fifth with a word there, then with a decimal place."""
    target = scratch_dir(spark, "registry")
    people = A.order_users(spark, sf_dir).withColumn("number", F.col("user_id").cast("string"))
    word = F.when(F.col("user_id") % 5 == 0, "DNI 00").otherwise("00")
    versions = [(0, F.concat(word, "number"), F.lit(OLD_EMAIL)), (1, F.concat("number", F.lit(".0")), F.col("email"))]
    first, last = [
        people.select(
            F.lit(turn).alias("turn"), "user_id", number.alias("Documento"), "username",
            F.date_format("signup_ts", "dd/MM/yyyy").alias("Fecha Alta"), email.alias("Correo"),
        ).withColumnRenamed("username", "Usuario")
        for turn, number, email in versions
    ]
    rows = first.unionByName(last).orderBy("turn", "user_id").drop("turn", "user_id")
    rows.write.option("header", True).csv(target)
    return read_readings(spark, target)


def users_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last and the first row of each user in a registry of duplicates and noisy ids."""
    readings = _readings(spark, sf_dir)
    sides = [r.withColumn("reading", F.lit(n)) for n, r in (("last", readings.last), ("first", readings.first))]
    return sides[0].unionByName(sides[1])


def reactivated_raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reactivated users of the same registry: every row of it counts, ids by their digits."""
    facts = classify(A.order_ledger(spark, sf_dir), A.ORDER_RULES)
    return users.reactivated_users(facts, _readings(spark, sf_dir).signups, A.ORDER_RULES)


def report_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total over the daily bet table of a written report bundle, per month."""
    target = scratch_dir(spark, "bundle")
    write_reports(
        spark, A.order_ledger(spark, sf_dir), target, A.order_users(spark, sf_dir), A.ORDER_RULES, "parquet"
    )
    return _totals(spark, target)


def bundle_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals after the orders of one year came in late and the reports were refreshed."""
    root = scratch_dir(spark, "refresh")
    store, reports = LedgerStore(spark, f"{root}/ledger"), ReportStore(spark, f"{root}/reports")
    rows, people = A.order_ledger(spark, sf_dir), A.order_users(spark, sf_dir)
    late = F.year("ts") == 1997
    for part in (rows.where(~late), rows.where(late)):
        store.upsert(part)
        reports.refresh(store, people, A.ORDER_RULES, "parquet")
    return _totals(spark, reports.folder())


def _totals(spark: SparkSession, target: str) -> DataFrame:
    daily = spark.read.parquet(f"{target}/apuestas_diario")
    games = spark.read.parquet(f"{target}/jugadores_unicos_por_juego")
    by_month = daily.groupBy(F.date_format("Fecha_Dia", "yyyy-MM").alias("AñoMes")).agg(
        F.sum(F.col("Recaudacion").cast("decimal(18,2)")).cast("double").alias("Recaudacion")
    )
    bets = games.groupBy("AñoMes").agg(
        F.sum("Bets_Mes").alias("Bets"),
        F.sum(F.col("Gastado_Mes").cast("decimal(18,2)")).cast("double").alias("Gastado"),
    )
    return by_month.join(bets, "AñoMes")


QUERIES = {
    "ingest_reports": ingest_reports,
    "ingest_broken_quotes": ingest_broken_quotes,
    "ingest_ledger": ingest_ledger,
    "ingest_text_ids": ingest_text_ids,
    "pending_files": pending,
    "manifest_upsert": manifest_upsert,
    "report_bundle": report_bundle,
    "bundle_refresh": bundle_refresh,
    "ingest_guard": ingest_guard,
    "dated_csv": dated_csv,
    "users_registry": users_registry,
    "reactivated_raw_registry": reactivated_raw_registry,
}


def oracles() -> dict[str, str]:
    from ledgerlens.plans.oracles import E, R, RU, amount_pivot

    row = """SELECT CAST(tx_id AS VARCHAR) AS tx_key, tx_id, date_trunc('second', ts) AS ts, movement_type, doc_id, description,
      CAST(amount AS DOUBLE) AS amount"""
    return {
        "ingest_reports": E + row + " FROM cls",
        "ingest_broken_quotes": E + row.replace(
            "description,", "CASE WHEN tx_id % 10 = 0 THEN description || chr(10) || 'next; line' ELSE description END AS description,"
        ) + " FROM cls",
        "ingest_ledger": E + row + ", month FROM cls",
        "ingest_guard": E + row + ", month FROM cls",
        "dated_csv": E + amount_pivot(),
        "users_registry": RU + f"""SELECT 'last' AS reading, user_id, username, email, signup_ts FROM users UNION ALL
          SELECT 'first', user_id, username, CASE WHEN user_id % 5 = 0 THEN email ELSE '{OLD_EMAIL}' END, signup_ts
          FROM users""",
        "reactivated_raw_registry": RU + f""", raw_users AS (SELECT user_id, username, email, signup_ts FROM users
            UNION ALL SELECT user_id, username, '{OLD_EMAIL}', signup_ts FROM users),
          after AS (SELECT doc_id, min(ts) AS ts FROM modo GROUP BY 1)
          SELECT user_id AS "Documento", signup_ts AS "Fecha_Alta", username AS "Usuario", email AS "Correo",
            ts AS "Fecha" FROM raw_users JOIN after ON doc_id = user_id
          WHERE year(signup_ts) BETWEEN 1994 AND 1997 AND ts >= TIMESTAMP '1998-07-07'""",
        "ingest_text_ids": E + """SELECT CASE tx_id % 3 WHEN 0 THEN CAST(tx_id AS VARCHAR)
          WHEN 1 THEN 'TX-' || tx_id END AS tx_key, CASE WHEN tx_id % 3 = 0 THEN tx_id END AS tx_id,
          date_trunc('second', ts) AS ts, doc_id, CAST(amount AS DOUBLE) AS amount FROM cls""",
        "pending_files": "SELECT 'first' AS stage, count(*) AS movements FROM events UNION ALL SELECT 'second', 0",
        "manifest_upsert": "SELECT true AS is_current, count(*) AS movements FROM events",
        "report_bundle": R + """SELECT month AS "AñoMes", CAST(sum(amount) AS DOUBLE) AS "Recaudacion",
          count(amount) AS "Bets", CAST(sum(amount) AS DOUBLE) AS "Gastado" FROM bets GROUP BY 1""",
        "bundle_refresh": R + """SELECT month AS "AñoMes", CAST(sum(amount) AS DOUBLE) AS "Recaudacion",
          count(amount) AS "Bets", CAST(sum(amount) AS DOUBLE) AS "Gastado" FROM bets GROUP BY 1""",
    }


