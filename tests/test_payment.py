from datetime import date
from decimal import Decimal

import pytest
from billing_rows import REF_DATE, RUN_TS, frames, invoice, payment

from billbook.config import AS_WRITTEN, INTENDED
from billbook.plans.stage import build_stage, latest_joined, payment_variables

# (invoice, payment) -> timing, days late, amount class, percent
BRANCHES = {
    1: ({}, None, "SEM_PAGAMENTO", 22, "SEM_PAGAMENTO", 0),
    2: ({"due": "2024-02-10"}, None, "SEM_PAGAMENTO", -9, "SEM_PAGAMENTO", 0),
    3: ({}, ("2024-01-15", "100.00"), "PAGAMENTO_ATRASADO", 5, "PAGAMENTO_TOTAL", 100),
    4: ({}, ("2024-01-10", "15.00"), "PAGAMENTO_NO_PRAZO", 0, "PAGAMENTO_MINIMO", 15),
    5: ({}, ("2024-01-02", "10.00"), "PAGAMENTO_ANTECIPADO", -1, "PAGAMENTO_INSUFICIENTE", 10),
    6: ({}, ("2024-01-10", "60.00"), "PAGAMENTO_NO_PRAZO", 0, "PAGAMENTO_PARCIAL", 60),
    7: ({}, ("2024-01-10", "120.00"), "PAGAMENTO_NO_PRAZO", 0, None, 120),
    8: ({"minimum": "100.00"}, ("2024-01-10", "100.00"), "PAGAMENTO_NO_PRAZO", 0, "PAGAMENTO_MINIMO", 100),
    9: ({"total": "0.00", "minimum": "0.00"}, ("2024-01-10", "5.00"), "PAGAMENTO_NO_PRAZO", 0, None, None),
    10: ({"due": None}, ("2024-01-10", "60.00"), None, None, "PAGAMENTO_PARCIAL", 60),
}


def _frames(spark):
    return frames(
        spark,
        [invoice(n, **case[0]) for n, case in BRANCHES.items()],
        [payment(n, *case[1]) for n, case in BRANCHES.items() if case[1]],
    )


def test_every_branch(spark):
    rows = payment_variables(latest_joined(*_frames(spark)), REF_DATE).collect()
    found = {
        r["id_fatura"]: (
            r["fbc_classificacao_dias_pagamento"], r["fvl_numero_dias_atraso"],
            r["fbc_classificacao_vlr_pagamento"], r["fvl_pct_fatura_pgto"],
        )
        for r in rows
    }
    assert found == {n: case[2:] for n, case in BRANCHES.items()}


@pytest.mark.parametrize("mode, unpaid, full", [(INTENDED, 0, 100), (AS_WRITTEN, None, 100)])
def test_percent_by_mode(spark, mode, unpaid, full):
    rows = payment_variables(latest_joined(*_frames(spark)), REF_DATE, mode).collect()
    found = {r["id_fatura"]: r["fvl_pct_fatura_pgto"] for r in rows}
    assert (found[1], found[3]) == (unpaid, full)


def test_stage_schema_and_values(spark):
    stage = build_stage(*_frames(spark), REF_DATE, RUN_TS)
    assert dict(stage.dtypes) == {
        "id_cliente": "bigint", "ref": "int", "dt_proc": "string",
        "fbc_classificacao_dias_pagamento": "string", "data_emissao": "date",
        "fvl_valor_fatura": "decimal(15,2)", "fvl_valor_pagamento_minimo": "decimal(15,2)",
        "fvl_valor_pagamento": "decimal(15,2)", "fbc_classificacao_vlr_pagamento": "string",
        "fvl_pct_fatura_pgto": "float", "fvl_numero_dias_atraso": "int", "fvl_qtd_transacao": "int",
    }
    rows = stage.collect()
    assert len(rows) == len(BRANCHES)
    assert {(r["ref"], r["dt_proc"], r["fvl_qtd_transacao"]) for r in rows} == {(202402, RUN_TS, 1)}
    assert {r["data_emissao"] for r in rows} == {date(2024, 1, 1)}
    paid = sum(Decimal(case[1][1]) for case in BRANCHES.values() if case[1])
    assert sum(r["fvl_valor_pagamento"] or 0 for r in rows) == paid


def test_two_payments_of_an_invoice_give_two_rows(spark):
    inv, pay = frames(
        spark,
        [invoice(1)],
        [payment(1, "2024-01-05", "40.00", number="a"), payment(1, "2024-01-06", "60.00", number="b")],
    )
    rows = build_stage(inv, pay, REF_DATE, RUN_TS).collect()
    assert sorted(r["fvl_valor_pagamento"] for r in rows) == [Decimal("40.00"), Decimal("60.00")]
    assert {r["fvl_valor_fatura"] for r in rows} == {Decimal("100.00")}
