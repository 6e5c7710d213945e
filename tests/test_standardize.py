from datetime import date
from decimal import Decimal

import pytest

from billbook.config import AS_WRITTEN, INTENDED
from billbook.operators.standardize import rejects, standardize_invoices, standardize_payments
from billbook.schema import INGESTION

RUN = "20240201080000"


def _invoices(spark, **columns):
    base = {
        "id_fatura": "F-7", "id_cliente": "5", "data_emissao": "2023-05-10",
        "data_vencimento": "2023-05-20", "valor_fatura": "100", "valor_pagamento_minimo": "15",
    }
    row = {**base, **columns}
    schema = INGESTION["tb_faturas"]
    return spark.createDataFrame([tuple(row[f.name] for f in schema)], schema)


def _first(df):
    return df.collect()[0]


@pytest.mark.parametrize("text, intended, as_written", [
    ("F-7", 7, 7), ("F-12", 12, 12), ("F-123", 123, 12), ("F123", None, 23), ("F-", None, None),
    ("F-x1", None, None), ("F-12-9", 12, 12), (None, None, None),
])
def test_invoice_id(spark, text, intended, as_written):
    df = _invoices(spark, id_fatura=text)
    assert _first(standardize_invoices(df, RUN))["id_fatura"] == intended
    assert _first(standardize_invoices(df, RUN, AS_WRITTEN))["id_fatura"] == as_written


@pytest.mark.parametrize("text, intended, as_written, ref", [
    ("2023-05-10", date(2023, 5, 10), date(2023, 1, 10), 202305),
    ("bad", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
    ("2023-02-30", None, date(2023, 1, 30), 202302),
    ("10/05/2023", None, None, None),
])
def test_dates(spark, text, intended, as_written, ref):
    df = _invoices(spark, data_emissao=text)
    row = _first(standardize_invoices(df, RUN))
    assert (row["data_emissao"], row["ref"]) == (intended, ref)
    row = _first(standardize_invoices(df, RUN, AS_WRITTEN))
    assert (row["data_emissao"], row["ref"]) == (as_written, ref)


@pytest.mark.parametrize("text, value", [
    ("1234.567", "1234.57"), ("-0.005", "-0.01"), ("12345678901234567.1", None), ("x", None), ("7", "7.00"),
])
def test_money(spark, text, value):
    row = _first(standardize_invoices(_invoices(spark, valor_fatura=text), RUN))
    assert row["valor_fatura"] == (Decimal(value) if value else None)


@pytest.mark.parametrize("mode", [INTENDED, AS_WRITTEN])
def test_payment(spark, mode):
    df = spark.createDataFrame(
        [("a-b-c", "F-123", "9", "2023-05-10", "10.005"), ("d", "F9", "z", "10/05/2023", "")],
        INGESTION["tb_pagamentos"],
    )
    one, two = standardize_payments(df, RUN, mode).collect()
    assert tuple(one) == ("abc", 123, 9, RUN, 202305, date(2023, 5, 10), Decimal("10.01"))
    assert tuple(two) == ("d", None, None, RUN, None, None, None)


def test_rejects(spark):
    df = standardize_invoices(
        _invoices(spark, id_cliente="x").unionByName(_invoices(spark)), RUN
    )
    assert [r["id_cliente"] for r in rejects(df).collect()] == [None]


def test_mode_is_checked(spark):
    with pytest.raises(ValueError):
        standardize_invoices(_invoices(spark), RUN, "literal")
