"""Malformed lines of a snapshot: kept with their text, never loaded as values."""

import os
from collections import Counter

import pytest
from billing_rows import LOAD_1, LOAD_2
from workload.billing import write_lines

from billbook.config import AS_WRITTEN
from billbook.operators.standardize import MALFORMED
from billbook.plans.jobs import load_job
from billbook.schema import CONTROL, INGESTION, LINE
from billbook.sources.ingestion import read_ingestion, read_lines
from billbook.sources.lake import read_raw, read_rejects
from billbook.streaming.daily_load import audit_arrivals, load_arrivals, reject_arrivals

HEADER = ",".join(INGESTION["tb_faturas"].names)
GOOD = [
    "F-1,1,2024-01-01,2024-01-10,100.00,15.00",
    '"F-7","1","2024-01-01","2024-01-10","100.00","15.00"',
    'F-8,1,2024-01-01,2024-01-10,"1""0",15.00',
    "F-9,1,2024-01-01,2024-01-10,100.00,",
    ",,,,,",
]
BAD = [
    "F-2,1,2024-01-01,2024-01-10,100,00,15,00",
    "F-3,1,2024-01-01",
    'F-4,1,"2024-01-01,2024-01-10,100.00,15.00',
    'F-5,1,2024-01-01,2024-01-10,100.00,"15.00',
    '"F-6,1,2024-01-01,2024-01-10,100.00,15.00',
    'F-8,1,2024-01-01,2024-01-10,10"0.00,15.00',
    'F-10,1,2024-01-01,2024-01-10,100.00,"1',
    '5.00"',
    "x" * 200_000,
]


def _snapshot(zones, lines, run_ts=LOAD_1, header=HEADER):
    path = zones.ingestion_run("tb_faturas", run_ts)
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as file:
        file.write("\n".join([header, *lines, ""]))
    open(f"{path}/_SUCCESS", "w").close()


def test_lines_are_told_apart(spark, zones):
    _snapshot(zones, [*GOOD, *BAD, ""])
    rows = read_lines(spark, zones, "tb_faturas").collect()
    assert Counter(r[LINE] for r in rows) == Counter(BAD) + Counter({None: len(GOOD)})
    values = [tuple(r)[:-1] for r in rows if r[LINE] is None]
    assert values[0] == tuple(GOOD[0].split(","))
    assert values[1] == ("F-7", "1", "2024-01-01", "2024-01-10", "100.00", "15.00")
    assert values[2][4] == '1"0' and values[3][5] is None and set(values[4]) == {None}
    assert read_ingestion(spark, zones, "tb_faturas").collect() == [v for v in values]


@pytest.mark.parametrize("quote", ["", '"'])
def test_headers_may_be_quoted_and_must_fit(spark, zones, quote):
    names = [f"{quote}{n}{quote}" for n in INGESTION["tb_faturas"].names]
    _snapshot(zones, GOOD, header=",".join(names))
    assert read_ingestion(spark, zones, "tb_faturas").count() == len(GOOD)
    _snapshot(zones, GOOD, LOAD_2, header=",".join([*names[:5], "outro"]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_ingestion(spark, zones, "tb_faturas").collect()


def test_load_keeps_every_line_in_one_place(spark, zones):
    _snapshot(zones, GOOD + BAD)
    for _ in range(2):
        assert load_job(spark, zones, "tb_faturas", LOAD_1) == len(GOOD)
    raw = read_raw(spark, zones, "faturas").collect()
    assert sorted(r.id_fatura or 0 for r in raw) == [0, 1, 7, 8, 9]
    assert {r.valor_pagamento_minimo for r in raw if r.id_fatura == 1} == {15}
    rejected = read_rejects(spark, zones, "faturas").collect()
    assert Counter(r[LINE] for r in rejected if r.motivo == MALFORMED) == Counter(BAD)
    assert [(r.motivo, r[LINE]) for r in rejected if r.motivo != MALFORMED] == [("sem chave", None)]
    audit = {tuple(r) for r in spark.read.schema(CONTROL).parquet(zones.control("faturas")).collect()}
    assert audit == {("faturas", LOAD_1, len(GOOD), len(BAD) + 1)}


def test_a_snapshot_without_malformed_lines_is_read_once(spark, zones, monkeypatch):
    import billbook.plans.jobs as jobs

    _snapshot(zones, GOOD)
    monkeypatch.setattr(jobs, "malformed", lambda lines: pytest.fail("read again"))
    load_job(spark, zones, "tb_faturas", LOAD_1)


def test_as_written_loads_what_it_can(spark, zones):
    _snapshot(zones, BAD[:2])
    load_job(spark, zones, "tb_faturas", LOAD_1, mode=AS_WRITTEN)
    # The second line's amounts are NULL, and so is nothing of the first: it reads 100 and 00.
    assert sorted(str(r.valor_fatura) for r in read_raw(spark, zones, "faturas").collect()) == ["100.00", "None"]
    assert {r.motivo for r in read_rejects(spark, zones, "faturas").collect()} <= {"sem chave"}


def test_overwrite_replaces_the_rejects_too(spark, zones):
    _snapshot(zones, GOOD + BAD)
    load_job(spark, zones, "tb_faturas", LOAD_1)
    _snapshot(zones, GOOD[:1] + BAD[:1], LOAD_2)
    load_job(spark, zones, "tb_faturas", LOAD_2, write_mode="overwrite")
    assert [(r.dt_proc, r[LINE]) for r in read_rejects(spark, zones, "faturas").collect()] == [(LOAD_2, BAD[0])]
    load_job(spark, zones, "tb_faturas", LOAD_1, snapshot_ts=LOAD_2, write_mode="overwrite")
    assert read_raw(spark, zones, "faturas").count() == 1


def test_overwrite_without_rejects_leaves_none(spark, zones):
    _snapshot(zones, BAD[:1])
    load_job(spark, zones, "tb_faturas", LOAD_1)
    _snapshot(zones, GOOD[:1], LOAD_2)
    load_job(spark, zones, "tb_faturas", LOAD_2, write_mode="overwrite")
    assert read_rejects(spark, zones, "faturas").count() == 0


def test_a_snapshot_of_a_header_only(spark, zones):
    _snapshot(zones, [])
    assert load_job(spark, zones, "tb_faturas", LOAD_1) == 0
    assert read_rejects(spark, zones, "faturas").count() == 0


def _arrive(spark, zones, *streams):
    for stream in streams:
        stream(spark, zones, "tb_faturas").awaitTermination()


def test_stream_rejects_and_audit(spark, zones):
    for run_ts, lines in ((LOAD_1, GOOD + BAD), (LOAD_2, GOOD[:2] + BAD[:1])):
        _snapshot(zones, lines, run_ts)
        _arrive(spark, zones, load_arrivals, reject_arrivals)
        audit_arrivals(spark, zones, "tb_faturas")
    _arrive(spark, zones, load_arrivals, reject_arrivals)
    audit_arrivals(spark, zones, "tb_faturas")
    audit = Counter(tuple(r) for r in spark.read.schema(CONTROL).parquet(zones.control("faturas")).collect())
    assert audit == Counter([("faturas", LOAD_1, len(GOOD), len(BAD) + 1), ("faturas", LOAD_2, 2, 1)])
    rejected = read_rejects(spark, zones, "faturas").where(f"{LINE} is not null").collect()
    assert Counter((r.dt_proc, r[LINE]) for r in rejected) == Counter([(LOAD_1, b) for b in BAD] + [(LOAD_2, BAD[0])])


def test_stream_audit_reads_new_runs_only(spark, zones, monkeypatch):
    import billbook.streaming.daily_load as daily

    seen = []
    control = daily.write_control
    monkeypatch.setattr(daily, "write_control", lambda df, path: (seen.append(df), control(df, path)))
    for run_ts in (LOAD_1, LOAD_2):
        _snapshot(zones, GOOD, run_ts)
        _arrive(spark, zones, load_arrivals)
        audit_arrivals(spark, zones, "tb_faturas")
    audit_arrivals(spark, zones, "tb_faturas")
    assert len(seen) == 2
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert f" = {LOAD_2})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert LOAD_1 not in plan


def test_lines_as_spark_writes_them(spark, zones):
    lines = spark.createDataFrame([(x,) for x in GOOD + BAD[:4]], f"`{HEADER}` string")
    write_lines(lines, zones.ingestion_run("tb_faturas", LOAD_1))
    assert Counter(r[LINE] for r in read_lines(spark, zones, "tb_faturas").collect()) == Counter(BAD[:4]) + Counter({None: 5})


def test_text_is_put_together_only_where_it_is_needed(spark, zones):
    _snapshot(zones, GOOD + BAD)
    lines = read_lines(spark, zones, "tb_faturas")
    inner = lines._jdf.queryExecution().analyzed().child().toString().splitlines()[0]
    assert "_quoted" in inner and "_line" not in inner  # no text of every line is carried on
