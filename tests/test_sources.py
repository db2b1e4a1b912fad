import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import at, movement, rows
from pyspark.sql import types as T

from ledgerlens.plans.bundle import write_reports
from ledgerlens.schema import LEDGER
from ledgerlens.sources import ledger as ledger_module
from ledgerlens.sources import reports as reports_module
from ledgerlens.sources.ledger import LedgerStore
from ledgerlens.sources.manifest import list_files, load_manifest, pending_files, save_manifest, upsert_manifest
from ledgerlens.sources.registry import read_readings, read_users, resolve_users
from ledgerlens.sources.reports import parse_reports, read_reports, report_lines, stored_lines, unique_movements
from ledgerlens.sources.tables import read_dated_csv, write_table
from ledgerlens.streaming.changes import ingest_changes
from ledgerlens.streaming.ingest import ingest_stream
from ledgerlens.streaming.loads import read_exact_loads, write_exact_loads

HEADER = "Nro. Transacción;Fecha;Tipo Mov.;Documento;Movimiento;Importe"


def put(folder, name, *lines, header=HEADER, mtime=None):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(["Reporte de movimientos", "", header, *lines]) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


def test_preamble_quotes_and_bad_cells(spark, tmp_path):
    folder = str(tmp_path)
    put(
        folder, "a.csv", '1;05/03/2025 10:00:00;Jugada;7;"Jugada - ""A; B""";1.234,56', "",
        "2;31/02/2025;Premio;x;;abc", "3;05/03/2025",
    )
    put(
        folder, "b.csv", "MODO;9;1;06/03/2025;ignored;Carga saldo desde MODO;10",
        header="Movimiento;Documento;Nro. Transacción;Fecha;Extra; TIPO MOV. ;Importe",
    )
    with open(os.path.join(folder, "~$a.csv"), "w") as lock:
        lock.write(HEADER + "\n99;;;;;\n")
    with open(os.path.join(folder, "c.csv"), "w") as other:
        other.write("no header here\n1;2;3\n")
    got = rows(read_reports(spark, folder).orderBy("file_name", "line").drop("tx_key", "file_name", "block", "line"))
    assert got == [
        (1, datetime(2025, 3, 5, 10), "Jugada", 7, 'Jugada - "A; B"', Decimal("1234.56")),
        (2, None, "Premio", None, "", None),
        (3, datetime(2025, 3, 5), None, None, None, None),
        (1, datetime(2025, 3, 6), "Carga saldo desde MODO", 9, "MODO", Decimal("10.00")),
    ]


def test_rows_before_the_first_header_are_left_out(spark, tmp_path):
    with open(tmp_path / "a.csv", "w", encoding="utf-8") as out:
        out.write("﻿x;y\n5;01/01/2025;Jugada;1;a;1\n" + HEADER + "\n6;01/01/2025;Jugada;1;tipo mov;1\n7;;;;;\n")
    assert [r.tx_id for r in read_reports(spark, str(tmp_path)).orderBy("line").collect()] == [6, 7]


def test_missing_column_is_an_error(spark, tmp_path):
    put(str(tmp_path), "a.csv", "1;Jugada", header="Nro. Transacción;Tipo Mov.")
    with pytest.raises(Exception, match="lacks the column"):
        read_reports(spark, str(tmp_path)).collect()


def test_one_row_per_transaction(spark, tmp_path):
    put(str(tmp_path), "a.csv", "1;01/01/2025;A;1;x;1", "1;01/01/2025;B;1;x;1")
    put(str(tmp_path), "b.csv", "1;01/01/2025;C;1;x;1", "2;01/01/2025;D;1;x;1")
    parsed = read_reports(spark, str(tmp_path))
    assert sorted(r.movement_type for r in unique_movements(parsed).collect()) == ["C", "D"]
    assert sorted(r.movement_type for r in unique_movements(parsed, "first").collect()) == ["A", "D"]


def test_large_report_splits_in_order(spark, tmp_path):
    lines = [f"{i % 500};01/01/2025;T{i};1;x;1" for i in range(5000)]
    put(str(tmp_path), "a.csv", *lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        parsed = read_reports(spark, str(tmp_path))
        assert parsed.select("block").distinct().count() > 3
        assert {r.movement_type for r in unique_movements(parsed).collect()} == {f"T{i}" for i in range(4500, 5000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_manifest(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "manifest")
    os.mkdir(folder)
    put(folder, "a.csv", mtime=1_700_000_000)
    put(folder, "b.csv", mtime=1_700_000_000)
    put(folder, "~$b.csv", mtime=1_700_000_000)

    def names():
        return sorted(r[0] for r in rows(pending_files(list_files(spark, folder), load_manifest(spark, target))))

    assert names() == ["a.csv", "b.csv"]
    save_manifest(list_files(spark, folder).select("file_name", "mod_time"), target)
    assert names() == []
    put(folder, "b.csv", mtime=1_700_000_060)
    assert names() == ["b.csv"]
    merged = upsert_manifest(load_manifest(spark, target), list_files(spark, folder))
    assert sorted(rows(merged)) == [("a.csv", 1_700_000_000), ("b.csv", 1_700_000_060)]
    write_table(spark.createDataFrame([("a", 1)], "name string, t int"), target, single_file=True)
    assert names() == ["a.csv", "b.csv"]
    assert load_manifest(spark, None).count() == 0


def test_ingest_is_incremental_and_idempotent(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    with pytest.raises(FileNotFoundError):
        store.ingest(folder)
    with pytest.raises(FileNotFoundError):
        store.read()
    put(folder, "a.csv", "1;01/01/2025;A;1;x;1", "2;01/02/2025;B;1;x;1", "3;bad;C;1;x;1", "1;02/01/2025;A2;1;x;1")
    with open(os.path.join(folder, "empty.csv"), "w") as out:
        out.write("nothing\n")

    def content():
        return sorted((r["tx_id"], r["movement_type"], r["month"]) for r in store.read().collect())

    assert store.ingest(folder) == ["a.csv"]
    first = [(1, "A2", "2025-01"), (2, "B", "2025-02"), (3, "C", "none")]
    assert content() == first and store.version() == 1
    assert store.ingest(folder) == [] and store.version() == 1
    put(folder, "b.csv", "1;01/03/2025;A3;1;x;1", "4;01/02/2025;D;1;x;1")
    assert store.ingest(folder) == ["b.csv"]
    # The moved row leaves January empty; the month without changes keeps its files.
    assert content() == [(1, "A3", "2025-03"), (2, "B", "2025-02"), (3, "C", "none"), (4, "D", "2025-02")]
    assert store.months() == {"2025-02": 2, "2025-03": 2, "none": 1}
    put(folder, "b.csv", "4;01/02/2025;D2;1;x;1", mtime=1_700_000_000)
    assert store.ingest(folder, keep="first") == ["b.csv"]
    assert (4, "D", "2025-02") in content()
    assert sorted(r[0] for r in rows(store.manifest())) == ["a.csv", "b.csv"]


def test_a_lost_run_changes_nothing(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    data = spark.createDataFrame([movement(1, "2025-01-01", "A", 1, "x", 1)], LEDGER)
    store.upsert(data)
    # Data of a version that was never finished.
    data.write.parquet(str(tmp_path / "data" / "v=2" / "month=2025-01"))
    assert store.read().count() == 1
    store.upsert(spark.createDataFrame([movement(2, "2025-01-01", "B", 1, "x", 1)], LEDGER))
    assert sorted(r["tx_id"] for r in store.read().collect()) == [1, 2]


def test_stream_ingest(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    store = LedgerStore(spark, str(tmp_path / "ledger"))

    def run():
        query = ingest_stream(store, folder, str(tmp_path / "checkpoint"), files_per_batch=1)
        query.awaitTermination()
        return sorted(r["movement_type"] for r in store.read().collect())

    put(folder, "a.csv", "1;01/01/2025;A;1;x;1", mtime=1_700_000_000)
    put(folder, "b.csv", "1;01/01/2025;B;1;x;1", "2;01/01/2025;C;1;x;1", mtime=1_700_000_100)
    assert run() == ["B", "C"]
    put(folder, "c.csv", "2;01/01/2025;D;1;x;1", mtime=1_700_000_200)
    assert run() == ["B", "D"]


def test_a_stream_writes_the_ledger_as_often_as_it_doubles(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    for k in range(9):
        put(folder, f"{k}.csv", f"1;01/01/2025;{k};1;x;1", f"{10 + k};01/01/2025;n;1;x;1", ";;n;1;y;1", ";;n;1;y;1",
            mtime=1_700_000_000 + k)
    ingest_stream(store, folder, str(tmp_path / "c"), files_per_batch=1).awaitTermination()
    # All there is was merged after batches 1, 3 and 7; two lie beside the ledger and are read with it.
    assert store.version() == 3 and store._arrived_batches(3) == 2
    found = [(r["tx_key"], r["movement_type"], r["month"]) for r in store.read().collect()]
    assert len(found) == len({r[0] for r in found}) == 1 + 9 + 18
    assert [r[1:] for r in found if r[0] == "1"] == [("8", "2025-01")]
    # What lies there is merged before what comes later, by whatever way.
    later = [movement(16, "2025-02-01", "B", 1, "x", 1), movement(30, "2025-02-01", "B", 1, "x", 1)]
    assert store.upsert(spark.createDataFrame(later, LEDGER)) == 5 and store._arrived_batches(5) == 0
    assert store.read().count() == 29
    assert [r["month"] for r in store.read().where("tx_key = '16'").collect()] == ["2025-02"]


def test_batches_that_arrive_keep_their_order(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    names = "dcba"  # Later batches have earlier names.
    for k, name in enumerate(names):
        put(folder, f"{name}.csv", f"1;01/0{k + 1}/2025;{k};1;x;1", f"{k // 3 + 5};01/01/2025;{k};1;x;1",
            mtime=1_700_000_000 + k)
    query = ingest_stream(store, folder, str(tmp_path / "c"), files_per_batch=1, keep="first")
    query.awaitTermination()
    found = {r["tx_key"]: (r["movement_type"], r["month"]) for r in store.read().collect()}
    assert found == {"1": ("0", "2025-01"), "5": ("0", "2025-01"), "6": ("3", "2025-01")}
    # The same batches once more, as a lost checkpoint brings them, now with the last row kept.
    ingest_stream(store, folder, str(tmp_path / "again"), files_per_batch=1).awaitTermination()
    assert {r["tx_key"]: (r["movement_type"], r["month"]) for r in store.read().collect()} == {
        "1": ("3", "2025-04"), "5": ("2", "2025-01"), "6": ("3", "2025-01")
    }
    assert store.settle() == store.version() and store.read().count() == 3
    put(folder, "bad.csv", "1;01/01/2025;A;1;x;1", mtime=1_800_000_000)
    bad = os.path.join(folder, "bad.csv")
    text = open(bad, encoding="utf-8").read().replace("Importe", "Otro")
    open(bad, "w", encoding="utf-8").write(text)
    with pytest.raises(Exception, match="lacks the column"):
        ingest_stream(store, folder, str(tmp_path / "c"), files_per_batch=1).awaitTermination()
    # The report fails its own batch and stays out of the ledger.
    assert store.read().count() == 3


def test_stream_reads_changed_files_again(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    store = LedgerStore(spark, str(tmp_path / "ledger"))

    def run():
        ingest_changes(store, folder, str(tmp_path / "checkpoint")).awaitTermination()
        return store.version(), sorted(r["movement_type"] for r in store.read().collect())

    put(folder, "a.csv", "1;01/01/2025;A;1;x;1", mtime=1_700_000_000)
    put(folder, "b.csv", "2;01/01/2025;B;1;x;1", mtime=1_700_000_000)
    put(folder, "~$a.csv", "9;01/01/2025;Z;1;x;1", mtime=1_700_000_000)
    assert run() == (1, ["A", "B"])
    assert run() == (1, ["A", "B"])
    put(folder, "a.csv", "1;01/01/2025;C;1;x;1", mtime=1_700_000_100)
    assert run() == (2, ["B", "C"])
    assert sorted(rows(store.manifest())) == [("a.csv", 1_700_000_100), ("b.csv", 1_700_000_000)]


def test_late_loads_correct_their_day(spark, ledger, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "loads")

    def run(*movements):
        ledger(*movements).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(LEDGER).parquet(folder)
        write_exact_loads(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
        return [
            (str(r[0]), *r[1:]) for r in read_exact_loads(spark, target).orderBy("Fecha_Dia", "Canal").collect()
        ]

    load = "Carga saldo desde MODO"
    first = run((1, "2025-01-01 10:00", load, 7, "a", 1.5), (2, "2025-01-09 10:00", load, 7, "a", 2), (3, None, load, 7, "a", 1))
    assert first == [("2025-01-01", "MODO", 1, 1.5, 1), ("2025-01-09", "MODO", 1, 2.0, 1)]
    # Days after the last time, with a user known there, a new one, and one without an id.
    late = run(
        (4, "2025-01-01 11:00", load, 7, "a", 1), (5, "2025-01-01 12:00", load, 8, "a", None),
        (6, "2025-01-01 12:00", load, None, "a", 1), (7, "2025-01-01 12:00", "Jugada", 9, "a", 1),
    )
    assert late == [("2025-01-01", "MODO", 3, 3.5, 2), ("2025-01-09", "MODO", 1, 2.0, 1)]
    assert run((8, "2025-01-02 12:00", "Jugada", 9, "a", 1)) == late
    # Only the touched day was written again.
    assert sorted(p.name for p in (tmp_path / "loads" / "users" / "batch=1").glob("day=*")) == ["day=2025-01-01"]


def test_registry(spark, tmp_path):
    with open(tmp_path / "u.csv", "w", encoding="utf-8") as out:
        out.write(
            "Válida, Fecha Alta ,Usuario,Documento,Correo,Ag/sub\n"
            "Si,05/03/2025 10:00:00,ana,00123,a@x,7\nNo,31/02/2025,bea,DNI 9,b@x,8\nSi,06/03/2025,ana2,123.0,a2@x,9\n"
        )
    users = read_users(spark, str(tmp_path / "u.csv"))
    assert users.columns == ["user_id", "username", "email", "signup_ts", "Válida", "Ag/sub"]
    assert rows(users) == [(123, "ana2", "a2@x", at("2025-03-06"), "Si", "9")]
    first = read_users(spark, str(tmp_path / "u.csv"), keep="first", lenient_ids=True)
    assert sorted(r[:2] for r in rows(first)) == [(9, "bea"), (123, "ana")]
    assert read_users(spark, str(tmp_path / "u.csv"), keep=None).count() == 2
    named = spark.createDataFrame([(1, "2025-01-01", 0)], "`Nro DNI` int, `FECHA DE ALTA` string, o int")
    assert rows(resolve_users(named, ["o"])) == [(1, None, None, at("2025-01-01"))]
    with pytest.raises(ValueError):
        resolve_users(spark.createDataFrame([(1, 0)], "x int, o int"), ["o"])


def test_dated_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("Fecha_Dia", T.DateType()), T.StructField("MODO", T.DoubleType())])
    missing = read_dated_csv(spark, str(tmp_path / "none.csv"), schema, "Fecha_Dia")
    assert missing.count() == 0 and missing.schema == schema
    with open(tmp_path / "t.csv", "w") as out:
        out.write("Fecha_Dia,MODO\n2025-03-04,1.5\nbad,\n")
    assert rows(read_dated_csv(spark, str(tmp_path / "t.csv"), schema, "Fecha_Dia")) == [
        (date(2025, 3, 4), 1.5), (None, None)
    ]
    with open(tmp_path / "d.csv", "w") as out:
        out.write("Fecha_Dia,MODO\n04/03/2025,1\n")
    assert rows(read_dated_csv(spark, str(tmp_path / "d.csv"), schema, "Fecha_Dia", dayfirst=True)) == [
        (date(2025, 3, 4), 1.0)
    ]


def test_bundle(spark, tmp_path, ledger, registry):
    book = ledger(
        (1, "2025-07-08 10:00:00", "Carga saldo desde MODO", 1, "x", 10),
        (2, "2025-07-08 11:00:00", "Jugada", 1, "Jugada - Quini 6", 4),
        (3, "2025-07-09 11:00:00", "Bonificación", 1, "alta", 1),
    )
    people = registry((1, "a", "a@x", "2022-01-01"), (2, "b", "b@x", "2025-07-08"))
    names = write_reports(spark, book, str(tmp_path), people)
    assert {"kpis", "top10_quini6", "usuarios_inactivos", "bonos_resumen", "cliente_mes"} <= set(names)

    def table(name):
        return spark.read.option("header", True).csv(str(tmp_path / name))

    assert table("recargas_monto").columns == ["Fecha_Dia", "MODO", "Retail"]
    assert table("kpis").count() == 12
    assert rows(table("comparativa_modo")) == [("Before 07/07/2025", "0.0", "0.0"), ("After 07/07/2025", "10.0", "4.0")]
    assert table("top10_quini6").columns == ["Documento", "Bets", "Gastado", "DNI", "Usuario", "Correo"]
    assert [r[1] for r in rows(table("usuarios_inactivos"))] == ["b"]


def test_text_and_missing_ids_stay_apart(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    ids = ["TX-1", "TX-2", "", "", "7", "7.0", "1.2", "1.7"]
    put(folder, "a.csv", *[f"{i};01/01/2025;A;1;x;{k}" for k, i in enumerate(ids)])
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.ingest(folder)
    assert sorted(int(r.amount) for r in store.read().collect()) == [0, 1, 2, 3, 5, 6, 7]
    put(folder, "a.csv", *[f"{i};01/01/2025;A;1;x;{k}" for k, i in enumerate(ids)], mtime=1_900_000_000)
    store.ingest(folder)
    assert store.read().count() == 7


def test_cells_that_break_over_lines(spark, tmp_path):
    put(
        str(tmp_path), "a.csv", '1;01/01/2025;A;1;"two', 'lines; ""quoted""";5', "2;01/01/2025;A;1;plain;6",
        '3;01/01/2025;A;1;5" pipe;7', "4;01/01/2025;A;1;plain;8",
    )
    put(str(tmp_path), "b.csv", '5;01/01/2025;A;1;a ""b"";9')
    got = {r.tx_id: (r.description, int(r.amount)) for r in read_reports(spark, str(tmp_path)).collect()}
    assert got[1] == ('two\nlines; "quoted"', 5) and got[2] == ("plain", 6) and got[4] == ("plain", 8)
    assert got.keys() == {1, 2, 3, 4, 5} and got[3][0].startswith('5" pipe')


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_records_go_over_chunks_of_a_file(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(reports_module, "CHUNK_LINES", chunk)
    put(
        str(tmp_path), "a.csv", '1;01/01/2025;A;1;"one', "two", "three", 'four; five";5', "2;01/01/2025;A;1;plain;6",
        *[f"{i};01/01/2025;A;1;x;7" for i in range(3, 9)], '9;01/01/2025;A;1;5" pipe;8', "10;01/01/2025;A;1;last;9",
    )
    got = {r.tx_id: (r.description, int(r.amount)) for r in read_reports(spark, str(tmp_path)).collect()}
    assert got.keys() == set(range(1, 11)) and got[1] == ("one\ntwo\nthree\nfour; five", 5)
    assert got[9][1] == 8 and got[10] == ("last", 9)


def test_places_do_not_depend_on_the_split_plan(spark, tmp_path):
    for name in "abc":
        put(str(tmp_path), f"{name}.csv", *[f"{name}{i};01/01/2025;A;1;x;1" for i in range(700)])
    lines = report_lines(spark.read, str(tmp_path))
    settings = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes")
    numbered = stored_lines(lines, str(tmp_path / "lines"))
    found = set()
    for number, size in ((1, "128m"), (50, "4k")):
        for key, value in zip(settings, (str(number), size)):
            spark.conf.set(key, value)
        try:
            found.add(parse_reports(numbered).count())
        finally:
            for key in settings:
                spark.conf.unset(key)
    assert found == {2100}


def test_bundle_takes_each_reading_of_the_registry(spark, tmp_path, ledger):
    book = ledger(
        (1, "2025-07-08 10:00:00", "Carga saldo desde MODO", 123, "x", 10),
        (2, "2025-07-08 11:00:00", "Jugada", 123, "Jugada - Quini 6", 4),
    )
    with open(tmp_path / "u.csv", "w") as out:
        out.write("DNI,Usuario,Correo,Fecha_Alta\n123,old,o@x,01/02/2022\nDNI 00123.0,other,p@x,01/02/2022\n123,new,n@x,01/02/2022\n")
    write_reports(spark, book, str(tmp_path / "out"), read_readings(spark, str(tmp_path / "u.csv")), fmt="parquet")

    def table(name):
        return spark.read.parquet(str(tmp_path / "out" / name))

    assert sorted(r["Usuario"] for r in table("reactivados_modo").collect()) == ["new", "old", "other"]
    assert [r["Usuario"] for r in table("top10_quini6").collect()] == ["old"]
    assert [r["Usuario"] for r in table("apuestas_con_usuarios").collect()] == ["new"]
    assert {r["KPI"]: r["Valor"] for r in table("kpis").collect()}["Total Usuarios Registrados"] == 1
    assert "_work" not in table("kpis").inputFiles()[0]


def test_an_ingest_reads_only_the_months_and_buckets_of_its_keys(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path), key_buckets=4)
    book = [movement(i, f"2025-0{1 + i % 3}-01", "A", 1, "x", i) for i in range(30)]
    store.upsert(spark.createDataFrame(book, LEDGER))
    before = store._state()
    assert before.key_buckets == 4 and set(before.keys.values()) == {1}
    moved = spark.createDataFrame([movement(3, "2025-02-01", "B", 1, "x", 7)], LEDGER)
    bucket = moved.selectExpr("pmod(xxhash64(cast(tx_id as string)), 4) as b").first()["b"]
    # Whatever else an ingest might read is broken: the month it does not touch, the other buckets.
    broken = [*(tmp_path / "data" / "v=1" / "month=2025-03").glob("*.parquet")]
    for b in set(range(4)) - {bucket}:
        broken += (tmp_path / "keys" / "v=1" / f"bucket={b}").glob("*.parquet")
    assert len(broken) >= 3
    kept = {path: path.read_bytes() for path in broken}
    for path in broken:
        path.write_bytes(b"broken")
        crc = path.with_name(f".{path.name}.crc")
        kept[crc] = crc.read_bytes()
        crc.write_bytes(b"")
    assert LedgerStore(spark, str(tmp_path)).upsert(moved) == 2
    for path, content in kept.items():
        path.write_bytes(content)
    after = store._state()
    assert after.key_buckets == 4 and {b for b, v in after.keys.items() if v == 2} == {bucket}
    assert after.months == {"2025-01": 2, "2025-02": 2, "2025-03": 1}
    found = {r["tx_id"]: (r["movement_type"], r["month"]) for r in store.read().collect()}
    assert len(found) == 30 and found[3] == ("B", "2025-02") and found[6] == ("A", "2025-01")
    # The index follows the moved row: its next change finds it in its new month.
    store.upsert(spark.createDataFrame([movement(3, "2025-03-01", "C", 1, "x", 7)], LEDGER))
    assert [(r["movement_type"], r["month"]) for r in store.read().where("tx_id = 3").collect()] == [("C", "2025-03")]


def test_a_ledger_without_an_index_of_keys_gets_one(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    store.upsert(spark.createDataFrame([movement(i, "2025-01-01", "A", 1, "x", i) for i in range(5)], LEDGER))
    old = spark.createDataFrame([("2025-01", 1, 2)], "month string, data_version int, v int")
    old.drop("v").write.parquet(str(tmp_path / "index" / "v=2"))
    assert store._state().keys == {}
    store.upsert(spark.createDataFrame([movement(1, "2025-02-01", "B", 1, "x", 1)], LEDGER))
    assert sorted((r["tx_id"], r["month"]) for r in store.read().collect()) == [
        (0, "2025-01"), (1, "2025-02"), (2, "2025-01"), (3, "2025-01"), (4, "2025-01")
    ]
    assert len(store._state().keys) == 16


def test_files_come_in_batches_and_their_buckets_alone_are_written(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    monkeypatch.setattr(ledger_module, "BATCH_FILES", 2)
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    for k, name in enumerate("abcde"):
        put(folder, f"{name}.csv", f"1;01/01/2025;{name};1;x;1", f"{10 + k};01/01/2025;{name};1;x;1")
    read = store.ingest_files(folder)
    assert sorted(r[0] for r in rows(read)) == ["a.csv", "b.csv", "c.csv", "d.csv", "e.csv"]
    assert store.version() == 3
    # Later names win, over the batches as within one.
    assert [r["movement_type"] for r in store.read().where("tx_id = 1").collect()] == ["e"]
    before = store._state().files
    put(folder, "c.csv", "1;01/01/2025;new;1;x;1", mtime=1_900_000_000)
    assert store.ingest(folder) == ["c.csv"] and store.ingest(folder) == []
    changed = {b for b, v in store._state().files.items() if v == 4}
    assert len(changed) == 1 and {b: v for b, v in store._state().files.items() if b not in changed}.items() <= before.items()
    assert len(rows(store.manifest())) == 5
