"""Books of several dates at once against a book for each."""

import random

import pytest
from billing_rows import LOAD_1, LOAD_2, frames, invoice, payment

from billbook.config import month_bounds
from billbook.plans.book import feature_book
from billbook.plans.books import feature_books, in_force
from billbook.plans.spec import BookSpec
from billbook.plans.stage import build_stage
from billbook.sources.lake import in_months

RUN = "20240301220000"
SPEC = BookSpec(windows=(1, 3, 12))
MONTHS = [f"{y}-{m:02}-01" for y, m in [(2023, m) for m in range(4, 13)] + [(2024, m) for m in range(1, 4)]]
ODD_DAYS = ["2023-03-31", "2023-05-15", "2023-06-30", "2024-02-29"]


def _tables(spark, seed=1):
    """Invoices and payments of three years with versions in several months and loads, ties and missing values."""
    rng = random.Random(seed)
    day = lambda: f"{rng.choice([2022, 2023, 2023, 2024])}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    month = lambda d: int(d[:4] + d[5:7])
    invoices, payments = [], []
    for n in range(220):
        customer = rng.choice([None, 1, 2, 3, 4, 5, 6])
        for _ in range(rng.choice([1, 1, 2, 3])):
            issued = day()
            invoices += [invoice(
                n, cliente=customer, load=rng.choice([LOAD_1, LOAD_2]), total=f"{rng.randint(1, 99)}.00", minimum="15.00",
                issued=issued, due=rng.choice([None, day()]), ref=month(issued),
            )] * rng.choice([1, 1, 2])
        for k in range(rng.choice([0, 1, 1, 2, 4])):
            paid = day()
            payments.append(payment(
                n, paid, rng.choice(["15.00", "9.00", "40.00"]), cliente=customer, load=rng.choice([LOAD_1, LOAD_2]),
                ref=month(paid), number=f"p{k}",
            ))
    return frames(spark, invoices, payments)


def _rows(df):
    near = lambda v: round(float(v), 6) if v is not None and not isinstance(v, (int, str)) else v
    return sorted((tuple(map(near, r)) for r in df.collect()), key=str)


def _each(tables, dates, spec, **kw):
    out = []
    for d in dates:
        look_back = [in_months(t, *month_bounds(d, max(spec.windows))) for t in tables]
        out += _rows(feature_book(build_stage(*look_back, d, RUN, **kw), spec, d))
    return sorted(out, key=str)


def test_twelve_months(spark):
    tables = _tables(spark)
    books = feature_books(*tables, MONTHS, RUN, SPEC)
    expected = _each(tables, MONTHS, SPEC)
    assert _rows(books) == expected and len({r[1] for r in expected}) == 12


def test_days_within_a_month_and_the_upper_bound(spark):
    tables, spec = _tables(spark, 2), BookSpec(windows=(1, 6), include_after_ref=False)
    assert _rows(feature_books(*tables, ODD_DAYS, RUN, spec)) == _each(tables, ODD_DAYS, spec)


def test_hot_keys_and_further_keys_take_each_date_on_its_own(spark):
    tables = _tables(spark, 3)
    by_payment = ("id_cliente", "id_fatura", "id_pagamento")
    dates, spec = MONTHS[:2], BookSpec(windows=(3,))
    assert _rows(feature_books(*tables, dates, RUN, spec, payment_keys=by_payment)) == _each(tables, dates, spec, payment_keys=by_payment)
    assert _rows(feature_books(*tables, dates, RUN, spec, rows_per_task=2)) == _each(tables, dates, spec)


def test_dates_are_one_a_month(spark):
    tables = _tables(spark)
    for dates in ([], ["2024-01-01", "2024-01-15"]):
        with pytest.raises(ValueError):
            feature_books(*tables, dates, RUN)


def test_one_scan_and_one_shuffle_per_table(spark, tmp_path):
    tables = []
    for i, t in enumerate(_tables(spark)):
        t.write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feature_books(*tables, MONTHS, RUN, SPEC)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2 and "Cartesian" not in plan and "NestedLoop" not in plan
    # One for each table, one for the partial aggregates and one for their layout by customer.
    assert plan.count("Exchange") <= 4


def test_versions_in_force(spark):
    inv, _ = frames(
        spark,
        [invoice(1, ref=202301), invoice(1, ref=202303), invoice(1, ref=202303, load=LOAD_2), invoice(1, ref=202306)],
        [payment(1, "2024-01-02", "1.00")],
    )
    at = lambda ref: ref // 100 * 12 + ref % 100
    rows = {(r.ref, r.dt_proc): (r._from, r._to) for r in in_force(inv, 2).collect()}
    assert rows == {
        (202301, LOAD_1): (at(202301), at(202302)), (202303, LOAD_2): (at(202303), at(202305)),
        (202306, LOAD_1): (at(202306), at(202308)),
    }
    every = sorted((r._from, r._to, r._held) for r in in_force(inv, 1, gaps=True).collect())
    assert all(a[1] + 1 == b[0] for a, b in zip(every, every[1:]))
    assert [held for *_, held in every] == [False, True, True, False, True, False]
