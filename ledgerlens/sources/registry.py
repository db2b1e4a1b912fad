"""The user registry: tolerant column names, clean ids, one row per user."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.text import dayfirst_ts, doc_key, fold_plain, numeric_id
from ledgerlens.operators.dedup import keep_one
from ledgerlens.session import scratch_dir


def _clean(name: str) -> str:
    return name.strip().replace(" ", "_")


def _find(columns: list[str], exact: tuple[str, ...], parts: tuple[tuple[str, ...], ...]) -> str | None:
    """First column with an exact name, else the first whose folded name holds all parts of a set."""
    for name in exact:
        if name in columns:
            return name
    for column in columns:
        folded = fold_plain(column).lower()
        if any(all(p in folded for p in group) for group in parts):
            return column
    return None


def resolve_users(
    raw: DataFrame, order: list[str], keep: str | None = "last", lenient_ids: bool = False
) -> DataFrame:
    """``user_id, username, email, signup_ts`` and the remaining columns.

    Rows without an id are dropped. ``keep`` picks the first or last row of an id in
    ``order``; None keeps all rows. ``lenient_ids`` takes the first digit run of the
    id text instead of reading it as a number.
    """
    named = raw.toDF(*[c if c in order else _clean(c) for c in raw.columns])
    columns = [c for c in named.columns if c not in order]
    user_id = _find(columns, ("DNI", "Documento"), (("dni",), ("doc",)))
    if user_id is None:
        raise ValueError(f"no DNI or Documento column among {columns}")
    signup = _find(columns, ("Fecha_Alta",), (("fecha", "alta"),))
    username = _find(columns, ("Usuario",), (("usuario",),))
    email = _find(columns, ("Correo",), (("correo",), ("mail",)))

    def text(column):
        return F.col(f"`{column}`") if column else F.lit(None).cast("string")

    def time(column):
        if column is None:
            return F.lit(None).cast("timestamp_ntz")
        if isinstance(named.schema[column].dataType, T.StringType):
            return dayfirst_ts(text(column))
        return text(column).cast("timestamp_ntz")

    clean_id = doc_key if lenient_ids else numeric_id
    used = {user_id, signup, username, email}
    users = named.select(
        clean_id(text(user_id)).alias("user_id"),
        text(username).alias("username"),
        text(email).alias("email"),
        time(signup).alias("signup_ts"),
        *[text(c).alias(c) for c in columns if c not in used],
        *order,
    ).dropna(subset=["user_id"])
    if keep is not None:
        users = keep_one(users, ["user_id"], order, keep)
    return users.drop(*order)


@dataclass(frozen=True)
class Readings:
    """The three readings of a registry that reports use."""

    last: DataFrame  # strict ids, the last row of each
    first: DataFrame  # strict ids, the first row of each
    signups: DataFrame  # ids by their first digit run, every row


def registry_readings(raw: DataFrame, order: list[str]) -> Readings:
    """All readings of one raw registry; ``order`` names the columns of its row order."""
    return Readings(
        resolve_users(raw, order, "last"),
        resolve_users(raw, order, "first"),
        resolve_users(raw, order, None, lenient_ids=True),
    )


def _ordered_rows(spark: SparkSession, path: str, sep: str) -> DataFrame:
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return raw.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


_ROW_ORDER = ["_file", "_block", "_line"]


def read_readings(spark: SparkSession, path: str, sep: str = ",") -> Readings:
    """The readings of a registry in delimited text with a header, in file order.

    The rows are numbered once and written, so all readings agree on their order."""
    rows, stored = _ordered_rows(spark, path, sep), scratch_dir(spark, "registry-rows")
    rows.write.parquet(stored)
    return registry_readings(spark.read.schema(rows.schema).parquet(stored), _ROW_ORDER)


def read_users(
    spark: SparkSession, path: str, sep: str = ",", keep: str | None = "last", lenient_ids: bool = False
) -> DataFrame:
    """Registry from delimited text with a header, in file order."""
    return resolve_users(_ordered_rows(spark, path, sep), _ROW_ORDER, keep, lenient_ids)
