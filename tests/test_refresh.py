"""Books refreshed for changed customers against books made as a whole."""

import shutil

from billing_rows import LOAD_1, LOAD_2, REF_DATE, RUN_TS, frames, invoice, payment

from billbook.config import Zones
from billbook.plans.book import book_schema
from billbook.plans.refresh import (
    SLICE, book_by_slices, changed_customers, keep_history, read_sliced, refresh_book,
)
from billbook.plans.spec import BookSpec
from billbook.schema import RAW, STAGE
from billbook.sinks.lake import write_run
from billbook.sources.folders import subfolders

SLICES, LATER = 6, "20240204220000"
SPEC = BookSpec(windows=(1, 12))
SCHEMAS = {"stage": STAGE}


def _load(spark, zones, tables, run_ts):
    for name, rows in zip(("faturas", "pagamentos"), tables):
        write_run(rows.where(f"dt_proc = '{run_ts}'"), zones.raw(name), run_ts)
        keep_history(spark, zones, name, run_ts, SLICES)


def _held(spark, zones, name):
    schema = SCHEMAS.get(name) or book_schema(SPEC)
    rows = read_sliced(spark, zones, name, schema, SLICES).collect()
    return {tuple(v for f, v in r.asDict().items() if f != "dt_proc") for r in rows}


def _whole(spark, zones, other):
    """Stage and book made anew, in another folder, from the same history."""
    shutil.copytree(zones.sliced("faturas", SLICES), other.sliced("faturas", SLICES))
    shutil.copytree(zones.sliced("pagamentos", SLICES), other.sliced("pagamentos", SLICES))
    book_by_slices(spark, other, REF_DATE, RUN_TS, SLICES, SPEC)
    return _held(spark, other, "stage"), _held(spark, other, "book")


def _tables(spark):
    invoices = [invoice(n, cliente=n % 20, total=f"{n}.00") for n in range(1, 80)]
    payments = [payment(n, "2024-01-05", f"{n}.00", cliente=n % 20, number=f"p{n}") for n in range(1, 50)]
    # The late load: another version, a new customer, a payment, and one whose month is not looked at.
    invoices += [invoice(4, cliente=4, total="9.00", load=LOAD_2), invoice(500, cliente=77, load=LOAD_2)]
    invoices += [invoice(6, cliente=6, ref=201901, load=LOAD_2), invoice(9, cliente=None, load=LOAD_2)]
    payments += [payment(65, "2024-01-06", "1.00", cliente=5, load=LOAD_2)]
    return frames(spark, invoices, payments)


def test_refresh_equals_the_whole_book(spark, zones, tmp_path):
    tables = _tables(spark)
    _load(spark, zones, tables, LOAD_1)
    book_by_slices(spark, zones, REF_DATE, RUN_TS, SLICES, SPEC)
    _load(spark, zones, tables, LOAD_2)
    changed = changed_customers(spark, zones, [LOAD_2], 202302, 202402, SLICES)
    assert sorted(r[0] for r in changed.collect()) == [4, 5, 77]
    touched = refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC)
    assert 1 <= len(touched) <= 3
    assert refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC) == touched
    assert (_held(spark, zones, "stage"), _held(spark, zones, "book")) == _whole(spark, zones, Zones(str(tmp_path / "whole")))
    made = {r.id_cliente for r in read_sliced(spark, zones, "book", book_schema(SPEC), SLICES).where(f"dt_proc = '{LATER}'").collect()}
    assert made == {4, 5, 77}


def test_other_slices_are_left_alone(spark, zones):
    tables = _tables(spark)
    _load(spark, zones, tables, LOAD_1)
    book_by_slices(spark, zones, REF_DATE, RUN_TS, SLICES, SPEC)
    files = lambda: {n: set(spark.read.parquet(zones.sliced(n, SLICES)).inputFiles()) for n in ("stage", "book")}
    before = files()
    _load(spark, zones, tables, LOAD_2)
    touched = refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC)
    own = tuple(f"{SLICE}={t}/" for t in touched)
    for name, after in files().items():
        moved = before[name] ^ after
        assert moved and all(any(o in f for o in own) for f in moved)
        assert before[name] & after
    pruned = read_sliced(spark, zones, "faturas", RAW["faturas"], SLICES).where(f"{SLICE} = {touched[0]}")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert f" = {touched[0]})" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_repeated_load_that_brings_less(spark, zones, tmp_path):
    """A customer of the first attempt only is taken out again, and an emptied slice with them."""
    tables = _tables(spark)
    _load(spark, zones, [t.where("id_cliente in (3, 4)") for t in tables], LOAD_1)
    book_by_slices(spark, zones, REF_DATE, RUN_TS, SLICES, SPEC)
    _load(spark, zones, tables, LOAD_2)
    refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC)
    _load(spark, zones, [t.where("id_fatura = 4") for t in tables], LOAD_2)
    refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC)
    assert (_held(spark, zones, "stage"), _held(spark, zones, "book")) == _whole(spark, zones, Zones(str(tmp_path / "whole")))
    assert {r[0] for r in read_sliced(spark, zones, "book", book_schema(SPEC), SLICES).select("id_cliente").collect()} == {3, 4}
    held = {f for f in subfolders(spark, f"{zones.sliced('book', SLICES)}/ref=202402")}
    assert len(held) <= 2


def test_nothing_to_refresh(spark, zones):
    tables = _tables(spark)
    _load(spark, zones, tables, LOAD_1)
    _load(spark, zones, [t.where("ref = 201901") for t in tables], LOAD_2)
    assert refresh_book(spark, zones, REF_DATE, LATER, [LOAD_2], SLICES, SPEC) == []


def test_a_month_that_was_never_made(spark, zones, tmp_path):
    tables = _tables(spark)
    _load(spark, zones, tables, LOAD_1)
    _load(spark, zones, tables, LOAD_2)
    refresh_book(spark, zones, REF_DATE, LATER, [LOAD_1, LOAD_2], SLICES, SPEC)
    assert (_held(spark, zones, "stage"), _held(spark, zones, "book")) == _whole(spark, zones, Zones(str(tmp_path / "whole")))
