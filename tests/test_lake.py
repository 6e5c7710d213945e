"""Zones end to end: extract, load, book, rerun, SQL, command line."""

import os
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from billing_rows import LOAD_1, LOAD_2, REF_DATE, RUN_TS, frames, invoice, payment

from billbook.__main__ import main, parser
from billbook.config import AS_WRITTEN, Zones
from billbook.plans.book import book_schema
from billbook.plans.jobs import book_job, extract_job, load_job
from billbook.plans.spec import BookSpec
from billbook.plans.stage import latest_versions
from billbook.schema import CONTROL, INGESTION
from billbook.session import scratch_dir
from billbook.sinks.lake import control_row, replace_months, write_control, write_months, write_raw
from billbook.sources.ingestion import extract_snapshot, newest_run, read_ingestion
from billbook.sources.lake import (
    in_months, read_look_back, read_raw, read_rejects, read_stage, register_zones,
)
from billbook.streaming.daily_load import audit_arrivals, load_arrivals

INVOICES = [
    ("F-1", "10", "2024-01-05", "2024-01-15", "100.00", "15.00"),
    ("F-2", "10", "2023-11-05", "2023-11-15", "200.00", "30.00"),
    ("F-3", "11", "2023-02-05", "2023-02-15", "50.00", "7.50"),
    ("F-4", "12", "2022-12-05", "2022-12-15", "70.00", "10.50"),
    ("F5", "12", "bad", "", "x", None),
]
PAYMENTS = [
    ("a-1", "F-1", "10", "2024-01-15", "100.00"),
    ("a-2", "F-2", "10", "2023-11-20", "60.00"),
]


def _text(spark, table, rows):
    return spark.createDataFrame(rows, INGESTION[table])


def _load_all(spark, zones, run_ts=LOAD_1):
    for table, rows in (("tb_faturas", INVOICES), ("tb_pagamentos", PAYMENTS)):
        extract_job(_text(spark, table, rows), zones, table, run_ts)
        load_job(spark, zones, table, run_ts)


def _rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_snapshot_round_trip(spark, zones):
    rows = [*INVOICES, ('F-"9"', "a,b", None, "", " x ", "1")]
    path = extract_snapshot(_text(spark, "tb_faturas", rows), zones, "tb_faturas", LOAD_1)
    assert path.endswith(f"00_ingestion/tb_faturas/tb_faturas_{LOAD_1[:8]}_{LOAD_1}")
    back = read_ingestion(spark, zones, "tb_faturas")
    assert {t for _, t in back.dtypes} == {"string"}
    # CSV has no NULL of its own: missing and empty text both come back as NULL
    expected = Counter(tuple(v or None for v in r) for r in rows)
    assert Counter(tuple(r) for r in back.collect()) == expected


def test_rerun_of_a_snapshot_replaces_it_and_newest_is_read(spark, zones):
    text = _text(spark, "tb_faturas", INVOICES)
    extract_snapshot(text, zones, "tb_faturas", LOAD_1)
    extract_snapshot(text, zones, "tb_faturas", LOAD_1)
    extract_snapshot(text.limit(2), zones, "tb_faturas", LOAD_2)
    assert newest_run(spark, zones, "tb_faturas").endswith(LOAD_2)
    assert read_ingestion(spark, zones, "tb_faturas").count() == 2
    assert read_ingestion(spark, zones, "tb_faturas", LOAD_1).count() == len(INVOICES)


def test_header_drift_raises(spark, zones):
    wrong = _text(spark, "tb_faturas", INVOICES).withColumnRenamed("valor_fatura", "valor")
    extract_snapshot(wrong, zones, "tb_faturas", LOAD_1)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_ingestion(spark, zones, "tb_faturas").collect()


def test_load_writes_months_and_audit(spark, zones):
    _load_all(spark, zones)
    raw = read_raw(spark, zones, "faturas")
    assert sorted((r["id_fatura"], r["ref"]) for r in raw.where("id_fatura is not null").collect()) == [
        (1, 202401), (2, 202311), (3, 202302), (4, 202212),
    ]
    assert [r["ref"] for r in raw.where("id_fatura is null").collect()] == [None]
    audit = spark.read.schema(CONTROL).parquet(zones.control("faturas")).collect()
    assert [tuple(r) for r in audit] == [("faturas", LOAD_1, 5, 1)]


def test_look_back_prunes_directories(spark, zones, capsys):
    _load_all(spark, zones)
    df = read_look_back(spark, zones, "faturas", REF_DATE)
    assert sorted(r["id_fatura"] for r in df.collect()) == [1, 2, 3]
    df.explain()
    plan = capsys.readouterr().out
    assert "202302" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_append_keeps_history_and_overwrite_replaces_the_table(spark, zones):
    text = _text(spark, "tb_faturas", INVOICES)
    for run_ts in (LOAD_1, LOAD_2):
        extract_snapshot(text, zones, "tb_faturas", run_ts)
        assert load_job(spark, zones, "tb_faturas", run_ts) == 5
    assert read_raw(spark, zones, "faturas").count() == 10
    load_job(spark, zones, "tb_faturas", LOAD_2, write_mode="overwrite")
    assert {r["dt_proc"] for r in read_raw(spark, zones, "faturas").collect()} == {LOAD_2}
    assert read_raw(spark, zones, "faturas").count() == 5


def test_replace_months_leaves_other_months(spark, zones):
    path = zones.raw("faturas")
    inv, _ = frames(
        spark, [invoice(1), invoice(2, ref=202312)], [payment(1, "2024-01-02", "1.00")]
    )
    write_months(inv, path, "append")
    changed, _ = frames(spark, [invoice(7)], [payment(1, "2024-01-02", "1.00")])
    for _ in range(2):
        replace_months(changed, path)
    back = spark.read.parquet(path)
    assert sorted(r["id_fatura"] for r in back.collect()) == [2, 7]
    assert in_months(back, 202312, 202312).count() == 1


def test_a_repeated_load_replaces_itself(spark, zones):
    _load_all(spark, zones, LOAD_1)
    extract_snapshot(_text(spark, "tb_faturas", INVOICES), zones, "tb_faturas", LOAD_2)
    load_job(spark, zones, "tb_faturas", LOAD_2)
    before = _rows(read_raw(spark, zones, "faturas"))
    assert load_job(spark, zones, "tb_faturas", LOAD_2) == 5
    assert _rows(read_raw(spark, zones, "faturas")) == before
    # A retry with fewer months leaves none of the first attempt's, and the other run alone.
    extract_snapshot(_text(spark, "tb_faturas", INVOICES[:2]), zones, "tb_faturas", LOAD_2)
    load_job(spark, zones, "tb_faturas", LOAD_2)
    runs = Counter(r["dt_proc"] for r in read_raw(spark, zones, "faturas").collect())
    assert runs == {LOAD_1: 5, LOAD_2: 2}
    assert [r["dt_proc"] for r in read_rejects(spark, zones, "faturas").collect()] == [LOAD_1]


def test_rejects_have_reasons(spark, zones):
    rows = [*INVOICES, ("F-9", None, "2024-01-05", "", "1", "1"), ("F-8", "1", "10/05/2024", "", "1", "1")]
    extract_snapshot(_text(spark, "tb_faturas", rows), zones, "tb_faturas", LOAD_1)
    assert load_job(spark, zones, "tb_faturas", LOAD_1) == 7
    found = [(r["id_fatura"], r["motivo"]) for r in read_rejects(spark, zones, "faturas").collect()]
    assert sorted(found, key=str) == [(8, "sem mes"), (9, "sem chave"), (None, "sem chave")]
    audit = spark.read.schema(CONTROL).parquet(zones.control("faturas")).first()
    assert (audit["qtd_registros"], audit["qtd_rejeitados"]) == (7, 3)


def test_a_rerun_without_rows_empties_the_month(spark, zones):
    _load_all(spark, zones)
    book_job(spark, zones, REF_DATE, RUN_TS)
    assert spark.read.parquet(zones.curated("book")).count() == 2
    write_raw(read_raw(spark, zones, "faturas").limit(0), zones.raw("faturas"), "overwrite")
    book_job(spark, zones, REF_DATE, "20240202220000")
    assert spark.read.schema(book_schema(BookSpec())).parquet(zones.curated("book")).count() == 0
    assert read_stage(spark, zones, 202402).count() == 0


def test_newest_run_starts_no_job_and_skips_unfinished_runs(spark, zones):
    text = _text(spark, "tb_faturas", INVOICES)
    for run_ts in (LOAD_1, LOAD_2):
        extract_snapshot(text, zones, "tb_faturas", run_ts)
    os.remove(f"{zones.ingestion_run('tb_faturas', LOAD_2)}/_SUCCESS")
    spark.sparkContext.setJobGroup("listing", "")
    assert newest_run(spark, zones, "tb_faturas").endswith(LOAD_1)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("listing")) == []
    spark.sparkContext.setJobGroup("", "")
    with pytest.raises(FileNotFoundError):
        newest_run(spark, zones, "tb_pagamentos")


def test_control_as_headerless_text(spark, zones):
    row = control_row(spark, "faturas", LOAD_1, 5)
    for _ in range(2):
        write_control(row, zones.control("faturas"), "csv")
    back = spark.read.csv(zones.control("faturas")).collect()
    assert [tuple(r) for r in back] == [("faturas", LOAD_1, "5", "0")] * 2


def test_book_job_and_its_rerun(spark, zones):
    _load_all(spark, zones, LOAD_1)
    _load_all(spark, zones, LOAD_2)
    book_job(spark, zones, REF_DATE, RUN_TS)
    first = _rows(spark.read.parquet(zones.curated("book")))
    stage = spark.read.parquet(zones.curated("stage"))
    assert stage.count() == 3
    by_customer = {r["id_cliente"]: r for r in spark.read.parquet(zones.curated("book")).collect()}
    assert sorted(by_customer) == [10, 11]
    # VAR_115: late, invoice total, 12 months, MIN; VAR_17: unpaid, invoice total, 12 months, SUM
    assert by_customer[10]["VAR_115"] == Decimal("200.00")
    assert by_customer[11]["VAR_17"] == Decimal("50.00")

    book_job(spark, zones, REF_DATE, RUN_TS)
    assert _rows(spark.read.parquet(zones.curated("book"))) == first
    book_job(spark, zones, "2024-01-01", RUN_TS)
    assert {r["ref"] for r in spark.read.parquet(zones.curated("book")).select("ref").collect()} == {202401, 202402}
    assert {r["ref"] for r in spark.read.parquet(zones.curated("stage")).select("ref").collect()} == {202401, 202402}


def test_as_written_job_counts_both_loads(spark, zones):
    for run_ts in (LOAD_1, LOAD_2):
        for table, rows in (("tb_faturas", INVOICES[:1]), ("tb_pagamentos", PAYMENTS[:1])):
            extract_job(_text(spark, table, rows), zones, table, run_ts)
            load_job(spark, zones, table, run_ts, mode=AS_WRITTEN)
    book_job(spark, zones, REF_DATE, RUN_TS, mode=AS_WRITTEN)
    stage = spark.read.parquet(zones.curated("stage"))
    assert stage.count() == 4
    assert {r["data_emissao"] for r in stage.collect()} == {date(2024, 1, 5)}
    # a rerun doubles the book, and another month drops the first from the stage
    book_job(spark, zones, REF_DATE, RUN_TS, mode=AS_WRITTEN)
    assert spark.read.parquet(zones.curated("book")).count() == 2
    book_job(spark, zones, "2024-01-01", RUN_TS, mode=AS_WRITTEN)
    stage = spark.read.parquet(zones.curated("stage"))
    assert {r["ref"] for r in stage.select("ref").collect()} == {202401}


def test_sql_over_the_lake(spark, zones):
    _load_all(spark, zones)
    book_job(spark, zones, REF_DATE, RUN_TS)
    tables = register_zones(spark, zones, "lake_test")
    assert tables == ["lake_test.faturas", "lake_test.pagamentos", "lake_test.stage", "lake_test.book"]
    rows = spark.sql("""
        select f.id_cliente, count(*) as n, max(b.VAR_17) as open
        from lake_test.faturas f join lake_test.book b on f.id_cliente = b.id_cliente
        where f.ref between 202302 and 202402 and b.ref = 202402 group by f.id_cliente
    """).collect()
    assert sorted(tuple(r) for r in rows) == [(10, 2, None), (11, 1, Decimal("50.00"))]
    _load_all(spark, zones, LOAD_2)
    register_zones(spark, zones, "lake_test", ["faturas"])
    assert spark.sql("select count(*) from lake_test.faturas").first()[0] == 10


def test_stream_loads_each_snapshot_once(spark, zones):
    text = _text(spark, "tb_faturas", INVOICES)
    third = "20240203080000"
    extract_snapshot(text, zones, "tb_faturas", LOAD_1)
    for _ in range(2):
        load_arrivals(spark, zones, "tb_faturas").awaitTermination()
    assert read_raw(spark, zones, "faturas").count() == 5
    # Two snapshots wait for one call and stay two runs, of which one is the latest.
    for run_ts in (LOAD_2, third):
        extract_snapshot(text, zones, "tb_faturas", run_ts)
    load_arrivals(spark, zones, "tb_faturas").awaitTermination()
    counts = Counter(r["dt_proc"] for r in read_raw(spark, zones, "faturas").collect())
    assert counts == {LOAD_1: 5, LOAD_2: 5, third: 5}
    latest = latest_versions(read_raw(spark, zones, "faturas")).collect()
    assert len(latest) == 4 and {r["dt_proc"] for r in latest} == {third}
    for _ in range(2):
        audit_arrivals(spark, zones, "tb_faturas")
    audit = spark.read.schema(CONTROL).parquet(zones.control("faturas")).collect()
    assert sorted(tuple(r) for r in audit) == [("faturas", run, 5, 1) for run in (LOAD_1, LOAD_2, third)]


def test_command_line(spark, zones, capsys):
    for table, rows in (("tb_faturas", INVOICES), ("tb_pagamentos", PAYMENTS)):
        extract_job(_text(spark, table, rows), zones, table, LOAD_1)
        main(["--root", zones.root, "--run-ts", LOAD_1, "load", table])
    main(["--root", zones.root, "--run-ts", RUN_TS, "book", "--ref-date", REF_DATE, "--documented"])
    assert len(spark.read.parquet(zones.curated("book")).columns) == 536 + 3
    statement = "select a.id_fatura from faturas a lateral view explode(sequence(1, 9)) as n"
    shared = ["--root", zones.root, "sql", statement, "--database", "lake_cli"]
    main([*shared, "--show", "2", "--output", f"{zones.root}/out"])
    spark.sql("USE default")
    assert spark.read.parquet(f"{zones.root}/out").count() == 45
    out = capsys.readouterr().out
    assert "tb_faturas: 5 rows" in out and "preview, 2 rows at most" in out
    with pytest.raises(SystemExit):
        main(shared)


def test_extract_arguments():
    args = parser().parse_args([
        "--root", "r", "extract", "tb_faturas", "--url", "jdbc:postgresql://h/d",
        "--partition-column", "id_cliente", "--lower", "0", "--upper", "9",
    ])
    assert (args.schema, args.partitions) == ("public", 64)


def test_scratch_follows_the_checkpoint_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(base) and one != two
    assert Zones(one).raw("faturas") == f"{one}/01_raw/faturas"
