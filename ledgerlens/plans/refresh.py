"""Reports kept beside a stored ledger and refreshed after an ingest.

The classified ledger and its daily roll-up are kept by month, each with the version of the
ledger's month it was made from. A refresh reads and classifies the months that an ingest wrote
anew, and makes the tables from what is kept. Tables go to a folder of their own; one small
file, written last, makes it current, so readers see all tables of one refresh or all of
another, and a lost run leaves the former ones. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.rules import Rules
from ledgerlens.operators.classify import classify, daily_rollup
from ledgerlens.plans.bundle import write_tables
from ledgerlens.sources.ledger import NO_MONTH, LedgerStore
from ledgerlens.sources.registry import Readings

#: Per month the ledger's version it was made from and the refresh that made it; the rules with them.
_CURRENT = "month string, ledger_version int, made_by int, rules string, v int"


@dataclass(frozen=True)
class ReportStore:
    spark: SparkSession
    root: str

    def _current(self) -> list:
        """The newest pointer: as many rows as the ledger has months."""
        try:
            rows = self.spark.read.schema(_CURRENT).parquet(f"{self.root}/current")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return rows.where(F.col("v") == rows.agg(F.max("v")).scalar()).collect()

    def folder(self) -> str:
        """Where the current tables are."""
        rows = self._current()
        if not rows:
            raise FileNotFoundError(f"no reports under {self.root}")
        return f"{self.root}/tables/v={rows[0]['v']}"

    def _write(self, df: DataFrame, kind: str, version: int) -> None:
        dealt = df.withColumn("part", F.coalesce("month", F.lit(NO_MONTH)))
        dealt.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(self._path(kind, version))

    def _path(self, kind: str, version: int) -> str:
        return f"{self.root}/{kind}/v={version}"

    def _read(self, kind: str, made: dict[str, int], version: int) -> DataFrame:
        schema = self.spark.read.parquet(self._path(kind, version)).drop("part").schema
        paths = [f"{self._path(kind, v)}/part={month}" for month, v in sorted(made.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def refresh(
        self,
        ledger: LedgerStore,
        people: DataFrame | Readings | None = None,
        rules: Rules = Rules(),
        fmt: str = "csv",
        people_changed: bool = False,
    ) -> list[str]:
        """Make the tables current; returns the months read from the ledger.

        Other rules mean every month is read anew. Without a changed month nothing is
        written, unless ``people_changed`` says that the registry is another one."""
        ledger.settle()
        months, rows = ledger.months(), self._current()
        if not months:
            raise FileNotFoundError(f"no ledger under {ledger.root}")
        version = max((r["v"] for r in rows), default=0) + 1
        held = {r["month"]: r for r in rows if r["rules"] == repr(rules)}
        touched = {m: v for m, v in months.items() if m not in held or held[m]["ledger_version"] != v}
        if not touched and len(held) == len(months) and not people_changed:
            return []
        made = {m: held[m]["made_by"] for m in months if m not in touched}
        if touched:
            facts = classify(ledger.read_months(touched), rules)
            self._write(facts, "facts", version)
            made |= dict.fromkeys(touched, version)
            self._write(daily_rollup(self._read("facts", {m: version for m in touched}, version)), "rollup", version)
        some = max(made.values())
        write_tables(
            self.spark, self._read("facts", made, some), self._read("rollup", made, some),
            f"{self.root}/tables/v={version}", people, rules, fmt,
        )
        pointer = [(m, months[m], made[m], repr(rules)) for m in sorted(months)]
        rows = self.spark.createDataFrame(pointer, "month string, ledger_version int, made_by int, rules string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/current/v={version}")
        return sorted(touched)
