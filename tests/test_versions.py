"""Bucketed latest versions against deduplication of the raw tables."""

from collections import Counter

import pytest
from billing_rows import LOAD_1, LOAD_2, frames, invoice, payment

from billbook.operators.dedup import dedup_latest
from billbook.plans.stage import latest_joined
from billbook.schema import INVOICE_KEYS, RAW
from billbook.sinks import versions
from billbook.sinks.lake import write_run
from billbook.sinks.versions import BUCKET, update_versions, versions_joined, versions_table
from billbook.sources.folders import subfolders
from billbook.sources.lake import read_raw

BUCKETS = 8


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _load(spark, zones, name, rows, run_ts):
    write_run(rows.where(f"dt_proc = '{run_ts}'"), zones.raw(name), run_ts)


def _held(spark, zones, name):
    return spark.table(versions_table(spark, zones, name, BUCKETS)).select(*RAW[name].names)


def _tables(spark):
    invoices = [invoice(n, cliente=n % 7, total=f"{n}.00") for n in range(1, 60)]
    invoices += [invoice(n, cliente=n % 7, total="9.00", load=LOAD_2) for n in range(1, 60, 9)]
    invoices += [invoice(n, cliente=n % 7, total="8.00", ref=202312, load=LOAD_2) for n in range(2, 60, 9)]
    invoices += [invoice(3, cliente=None), invoice(70, cliente=1, load=LOAD_2)] + [invoice(71, cliente=1)] * 3
    payments = [payment(n % 40, "2024-01-05", f"{n}.00", cliente=n % 40 % 7, number=f"p{n}") for n in range(1, 90)]
    payments += [payment(5, "2024-01-06", "1.00", cliente=5, number=f"q{n}", load=LOAD_2) for n in range(4)]
    return frames(spark, invoices, payments)


def test_runs_in_any_order_give_the_latest_versions(spark, zones):
    for name, rows in zip(("faturas", "pagamentos"), _tables(spark)):
        for run_ts in (LOAD_2, LOAD_1):
            _load(spark, zones, name, rows, run_ts)
            update_versions(spark, zones, name, run_ts, BUCKETS)
            loaded = read_raw(spark, zones, name)
            assert _rows(_held(spark, zones, name)) == _rows(dedup_latest(loaded).select(*RAW[name].names))
    both = [read_raw(spark, zones, n) for n in ("faturas", "pagamentos")]
    assert _rows(versions_joined(spark, zones, BUCKETS)) == _rows(latest_joined(*both))


def test_large_buckets_are_sorted_in_several_tasks(spark, zones, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_TO_SORT", 3)
    _, paid = _tables(spark)
    for run_ts in (LOAD_1, LOAD_2, LOAD_1):
        _load(spark, zones, "pagamentos", paid, run_ts)
        update_versions(spark, zones, "pagamentos", run_ts, BUCKETS)
    files = Counter(f.split(f"{BUCKET}=")[1].split("/")[0] for f in _files(spark, zones.versions("pagamentos", BUCKETS)))
    assert max(files.values()) > 1
    held = spark.read.parquet(zones.versions("pagamentos", BUCKETS))
    assert held.where(f"{BUCKET} <> pmod(hash({', '.join(INVOICE_KEYS)}), {BUCKETS})").isEmpty()
    loaded = read_raw(spark, zones, "pagamentos")
    assert _rows(_held(spark, zones, "pagamentos")) == _rows(dedup_latest(loaded).select(*RAW["pagamentos"].names))


def test_only_touched_buckets_are_written(spark, zones):
    inv, _ = _tables(spark)
    _load(spark, zones, "faturas", inv, LOAD_1)
    assert len(update_versions(spark, zones, "faturas", LOAD_1, BUCKETS)) == BUCKETS
    path = zones.versions("faturas", BUCKETS)
    before = _files(spark, path)
    _load(spark, zones, "faturas", inv.where("id_fatura = 10"), LOAD_2)
    (bucket,) = update_versions(spark, zones, "faturas", LOAD_2, BUCKETS)
    after = _files(spark, path)
    assert {f for f in before ^ after} == {f for f in before | after if f"{BUCKET}={bucket}/" in f}
    assert _rows(_held(spark, zones, "faturas")) == _rows(dedup_latest(read_raw(spark, zones, "faturas")).select(*RAW["faturas"].names))


def _files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_join_plans_no_exchange(spark, zones):
    for name, rows in zip(("faturas", "pagamentos"), _tables(spark)):
        for run_ts in (LOAD_1, LOAD_2):
            _load(spark, zones, name, rows, run_ts)
            update_versions(spark, zones, name, run_ts, BUCKETS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = versions_joined(spark, zones, BUCKETS)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_repeated_run_brings_back_what_it_had_replaced(spark, zones):
    inv, _ = _tables(spark)
    for run_ts in (LOAD_1, LOAD_2):
        _load(spark, zones, "faturas", inv, run_ts)
        update_versions(spark, zones, "faturas", run_ts, BUCKETS)
    for fewer in (inv, inv.where("id_fatura < 20"), inv.where("id_fatura < 0")):
        _load(spark, zones, "faturas", fewer, LOAD_2)
        update_versions(spark, zones, "faturas", LOAD_2, BUCKETS)
        expected = dedup_latest(read_raw(spark, zones, "faturas")).select(*RAW["faturas"].names)
        assert _rows(_held(spark, zones, "faturas")) == _rows(expected)


def test_emptied_buckets_and_empty_runs(spark, zones):
    inv, _ = _tables(spark)
    _load(spark, zones, "faturas", inv.where("id_fatura < 0"), LOAD_1)
    assert update_versions(spark, zones, "faturas", LOAD_1, BUCKETS) == []
    _load(spark, zones, "faturas", inv, LOAD_2)
    update_versions(spark, zones, "faturas", LOAD_2, BUCKETS)
    _load(spark, zones, "faturas", inv.where("id_fatura = 10"), LOAD_2)
    update_versions(spark, zones, "faturas", LOAD_2, BUCKETS)
    assert [r.id_fatura for r in _held(spark, zones, "faturas").collect()] == [10]
    assert sum(f.startswith(BUCKET) for f in subfolders(spark, zones.versions("faturas", BUCKETS))) == 1


def test_a_run_that_was_broken_off_is_repeated(spark, zones, monkeypatch):
    import billbook.sinks.versions as versions

    inv, _ = _tables(spark)
    _load(spark, zones, "faturas", inv, LOAD_1)
    with monkeypatch.context() as m:
        m.setattr(versions, "_placed", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_versions(spark, zones, "faturas", LOAD_1, BUCKETS)
    update_versions(spark, zones, "faturas", LOAD_1, BUCKETS)
    expected = dedup_latest(read_raw(spark, zones, "faturas")).select(*RAW["faturas"].names)
    assert _rows(_held(spark, zones, "faturas")) == _rows(expected)


def test_hot_keys(spark, zones):
    inv, pay = frames(
        spark, [invoice(1)] * 25 + [invoice(n) for n in range(2, 30)],
        [payment(1, "2024-01-05", "5.00", number=f"p{n}") for n in range(60)]
        + [payment(1, "2024-01-05", "4.00", ref=202312, number=f"o{n}") for n in range(60)]
        + [payment(2, "2024-01-05", "5.00")],
    )
    for name, rows in (("faturas", inv), ("pagamentos", pay)):
        _load(spark, zones, name, rows, LOAD_1)
        update_versions(spark, zones, name, LOAD_1, BUCKETS, rows_per_task=20)
        assert _rows(_held(spark, zones, name)) == _rows(dedup_latest(rows).select(*RAW[name].names))
    joined = versions_joined(spark, zones, BUCKETS, rows_per_task=20)
    assert _rows(joined) == _rows(latest_joined(inv, pay, rows_per_task=None))
