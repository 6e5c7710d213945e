"""The numbering of the book, pinned block by block without the generator."""

from collections import Counter

import pytest

from billbook.plans.spec import BookSpec, expand

TIMING, AMOUNT = "fbc_classificacao_dias_pagamento", "fbc_classificacao_vlr_pagamento"
CLASSES = [
    (TIMING, "SEM_PAGAMENTO"), (TIMING, "PAGAMENTO_ATRASADO"), (TIMING, "PAGAMENTO_NO_PRAZO"),
    (TIMING, "PAGAMENTO_ANTECIPADO"), (AMOUNT, "PAGAMENTO_INSUFICIENTE"), (AMOUNT, "PAGAMENTO_TOTAL"),
    (AMOUNT, "PAGAMENTO_PARCIAL"),
]
# measure, first and last number within a class of 95, aggregates
BLOCKS = [
    ("fvl_valor_fatura", 1, 20, "SUM AVG MAX MIN"),
    ("fvl_valor_pagamento_minimo", 21, 40, "SUM AVG MAX MIN"),
    ("fvl_valor_pagamento", 41, 60, "SUM AVG MAX MIN"),
    ("fvl_numero_dias_atraso", 61, 75, "AVG MAX MIN"),
    ("fvl_qtd_transacao", 76, 80, "SUM"),
    ("fvl_pct_fatura_pgto", 81, 95, "AVG MAX MIN"),
]


def test_all_665_variables():
    by_name = {v.name: v for v in expand()}
    assert list(by_name) == [f"VAR_{i}" for i in range(1, 666)]
    for c, (column, value) in enumerate(CLASSES):
        for measure, first, last, aggregates in BLOCKS:
            wanted = aggregates.split()
            for number in range(first, last + 1):
                v = by_name[f"VAR_{95 * c + number}"]
                step, position = divmod(number - first, len(wanted))
                assert (v.class_column, v.class_value, v.measure) == (column, value, measure)
                assert (v.months, v.aggregate) == ((1, 3, 6, 9, 12)[step], wanted[position])


@pytest.mark.parametrize("name, expected", [
    ("VAR_1", (TIMING, "SEM_PAGAMENTO", "fvl_valor_fatura", 1, "SUM")),
    ("VAR_17", (TIMING, "SEM_PAGAMENTO", "fvl_valor_fatura", 12, "SUM")),
    ("VAR_95", (TIMING, "SEM_PAGAMENTO", "fvl_pct_fatura_pgto", 12, "MIN")),
    ("VAR_96", (TIMING, "PAGAMENTO_ATRASADO", "fvl_valor_fatura", 1, "SUM")),
    ("VAR_381", (AMOUNT, "PAGAMENTO_INSUFICIENTE", "fvl_valor_fatura", 1, "SUM")),
    ("VAR_665", (AMOUNT, "PAGAMENTO_PARCIAL", "fvl_pct_fatura_pgto", 12, "MIN")),
])
def test_landmarks(name, expected):
    v = next(v for v in expand() if v.name == name)
    assert (v.class_column, v.class_value, v.measure, v.months, v.aggregate) == expected


def test_shares():
    assert Counter(v.aggregate for v in expand()) == {"SUM": 140, "AVG": 175, "MAX": 175, "MIN": 175}
    assert set(Counter(v.months for v in expand()).values()) == {133}


def test_documented_exclusions():
    variables = expand(BookSpec().documented())
    assert len(variables) == 536
    assert variables[-1].name == "VAR_536"
    assert {v.aggregate for v in variables if v.months == 1} == {"SUM"}
    with_pct = {v.class_value for v in variables if v.measure == "fvl_pct_fatura_pgto"}
    assert not with_pct & {"SEM_PAGAMENTO", "PAGAMENTO_TOTAL"}


def test_windows_must_ascend():
    with pytest.raises(ValueError):
        BookSpec(windows=(3, 1))
