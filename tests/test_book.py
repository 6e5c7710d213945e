from dataclasses import replace
from decimal import Decimal

import pytest
from billing_rows import REF_DATE, frames, invoice, payment, random_stage, RUN_TS

from billbook.plans.book import feature_book, feature_book_direct, feature_book_long
from billbook.plans.spec import BookSpec, expand
from billbook.plans.stage import build_stage

SPECS = {
    "default": BookSpec(),
    "documented": BookSpec().documented(),
    "up_to_reference": BookSpec(include_after_ref=False),
    "two_windows": replace(BookSpec(), windows=(2, 24)),
    "one_class_column": replace(BookSpec(), classes=BookSpec().classes[1:]),
}


def _by_customer(df):
    return {
        r["id_cliente"]: {
            k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()
        }
        for r in df.collect()
    }


@pytest.mark.parametrize("name", SPECS)
def test_equals_direct_aggregation(spark, name):
    stage = random_stage(spark)
    direct = feature_book_direct(stage, SPECS[name], REF_DATE)
    book = feature_book(stage, SPECS[name], REF_DATE)
    assert [(f.name, f.dataType) for f in book.schema] == [(f.name, f.dataType) for f in direct.schema]
    assert _by_customer(book) == _by_customer(direct)


def test_customers_without_cells_stay(spark):
    book = _by_customer(feature_book(random_stage(spark), BookSpec(), REF_DATE))
    for customer in (900, 901):
        assert {v for k, v in book[customer].items() if k.startswith("VAR_")} == {None}


def test_long_equals_wide(spark):
    stage = random_stage(spark)
    wide = _by_customer(feature_book(stage, BookSpec(), REF_DATE))
    long = {
        (r["id_cliente"], r["variable"]): r
        for r in feature_book_long(stage, BookSpec(), REF_DATE).collect()
    }
    filled = {
        (c, k): v for c, row in wide.items() for k, v in row.items()
        if k.startswith("VAR_") and v is not None
    }
    assert long.keys() == filled.keys()
    assert all(abs(r["value"] - float(filled[k])) < 1e-6 for k, r in long.items())
    described = {v.name: v for v in expand()}
    for r in long.values():
        v = described[r["variable"]]
        assert (r["class_value"], r["measure"], r["months"], r["aggregate"]) == (
            v.class_value, v.measure, v.months, v.aggregate
        )


def test_windows_nest_and_min_avg_max_order(spark):
    rows = feature_book(random_stage(spark), BookSpec(), REF_DATE).collect()
    groups = {}
    for v in expand():
        groups.setdefault((v.class_value, v.class_column, v.measure), {})[v.months, v.aggregate] = v.name
    for r in rows:
        for cells in groups.values():
            counts = [r[cells[n, "SUM"]] or 0 for n in (1, 3, 6, 9, 12)] if (1, "SUM") in cells else []
            if counts and cells[1, "SUM"] in {v.name for v in expand() if v.measure == "fvl_qtd_transacao"}:
                assert counts == sorted(counts)
            for n in (1, 3, 6, 9, 12):
                if (n, "AVG") in cells and r[cells[n, "AVG"]] is not None:
                    low, mean, high = (float(r[cells[n, a]]) for a in ("MIN", "AVG", "MAX"))
                    assert low - 1e-6 <= mean <= high + 1e-6


def test_one_customer_by_hand(spark):
    inv, pay = frames(
        spark,
        [invoice(1), invoice(2, total="50.00", issued="2023-11-15", due="2023-11-25", ref=202311), invoice(3)],
        [payment(1, "2024-01-15", "100.00"), payment(2, "2023-11-30", "20.00", ref=202311)],
    )
    row = feature_book(build_stage(inv, pay, REF_DATE, RUN_TS), BookSpec(), REF_DATE).collect()[0]
    names = {
        (v.class_value, v.measure, v.months, v.aggregate): v.name for v in expand()
    }

    def value(*key):
        return row[names[key]]

    assert value("SEM_PAGAMENTO", "fvl_valor_fatura", 1, "SUM") == Decimal("100.00")
    assert value("SEM_PAGAMENTO", "fvl_numero_dias_atraso", 12, "AVG") == 22.0
    assert value("SEM_PAGAMENTO", "fvl_pct_fatura_pgto", 12, "MAX") == 0.0
    assert value("PAGAMENTO_ATRASADO", "fvl_qtd_transacao", 1, "SUM") == 1
    assert value("PAGAMENTO_ATRASADO", "fvl_qtd_transacao", 3, "SUM") == 2
    assert value("PAGAMENTO_ATRASADO", "fvl_valor_fatura", 3, "AVG") == Decimal("75.000000")
    assert value("PAGAMENTO_TOTAL", "fvl_valor_pagamento", 12, "MIN") == Decimal("100.00")
    assert value("PAGAMENTO_PARCIAL", "fvl_pct_fatura_pgto", 3, "MAX") == 40.0
    assert value("PAGAMENTO_PARCIAL", "fvl_pct_fatura_pgto", 1, "MAX") is None
    assert value("PAGAMENTO_NO_PRAZO", "fvl_qtd_transacao", 12, "SUM") is None
