"""Reports refreshed after an ingest: equal to a full run, only changed months read."""

import pytest
from conftest import SMALL

from ledgerlens.functions.rules import Rules
from ledgerlens.plans import adapters as A
from ledgerlens.plans.bundle import write_reports
from ledgerlens.plans.refresh import ReportStore
from ledgerlens.sources.ledger import LedgerStore


def tables(spark, folder, names):
    frames = {name: spark.read.parquet(f"{folder}/{name}") for name in names}
    return {name: (df.columns, sorted(map(str, df.collect()))) for name, df in frames.items()}


def test_a_refresh_equals_a_full_run_and_reads_one_month(spark, tmp_path, monkeypatch):
    rows = A.order_ledger(spark, SMALL).where("doc_id % 4 = 0 and (ts >= '1997-06-01' or ts is null)")
    people = A.order_users(spark, SMALL)
    late = "ts >= '1998-03-05' and ts < '1998-03-20'"
    store = LedgerStore(spark, f"{tmp_path}/ledger")
    reports = ReportStore(spark, f"{tmp_path}/reports")
    with pytest.raises(FileNotFoundError):
        reports.folder()
    store.upsert(rows.where(f"not ({late}) or ts is null"))
    assert reports.refresh(store, people, A.ORDER_RULES, "parquet") == sorted(store.months())
    before = reports.folder()

    store.upsert(rows.where(late))
    read = []
    plain = LedgerStore._read
    monkeypatch.setattr(LedgerStore, "_read", lambda self, months: read.append(sorted(months)) or plain(self, months))
    assert reports.refresh(store, people, A.ORDER_RULES, "parquet") == ["1998-03"]
    assert read == [["1998-03"]]
    monkeypatch.undo()
    assert reports.folder() != before

    names = write_reports(spark, store.read(), f"{tmp_path}/full", people, A.ORDER_RULES, "parquet")
    assert len(names) > 30
    whole = tables(spark, f"{tmp_path}/full", names)
    for name, found in tables(spark, reports.folder(), names).items():
        assert found == whole[name], name

    # Nothing came in: nothing is read or written.
    now = reports.folder()
    assert reports.refresh(store, people, A.ORDER_RULES, "parquet") == [] and reports.folder() == now

    # A run lost while it writes tables leaves the former ones current.
    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("ledgerlens.plans.refresh.write_tables", lost)
    with pytest.raises(RuntimeError):
        reports.refresh(store, people, A.ORDER_RULES, "parquet", people_changed=True)
    assert reports.folder() == now
    # Other rules: every month is read.
    monkeypatch.setattr("ledgerlens.plans.refresh.write_tables", lambda *_: None)
    assert reports.refresh(store, people, Rules(), "parquet") == sorted(store.months())


def test_an_empty_ledger_has_no_reports(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ReportStore(spark, f"{tmp_path}/r").refresh(LedgerStore(spark, f"{tmp_path}/l"), None, Rules())
