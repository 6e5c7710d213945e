"""Literal billing rows and random stages for the tests."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

from billbook.plans.spec import CLASSES
from billbook.schema import STAGE

INVOICE = "id_fatura long, id_cliente long, dt_proc string, data_emissao date, data_vencimento date, " \
    "valor_fatura decimal(15,2), valor_pagamento_minimo decimal(15,2), ref int"
PAYMENT = "id_pagamento string, id_fatura long, id_cliente long, dt_proc string, " \
    "data_pagamento date, valor_pagamento decimal(15,2), ref int"
LOAD_1, LOAD_2 = "20240201080000", "20240202080000"
REF_DATE = "2024-02-01"
RUN_TS = "20240201220000"


def invoice(fatura, cliente=1, load=LOAD_1, due="2024-01-10", total="100.00", minimum="15.00",
            issued="2024-01-01", ref=202401):
    day = date.fromisoformat
    return (fatura, cliente, load, day(issued), day(due) if due else None,
            Decimal(total), Decimal(minimum), ref)


def payment(fatura, paid, amount, cliente=1, load=LOAD_1, ref=202401, number="p1"):
    return (number, fatura, cliente, load, date.fromisoformat(paid), Decimal(amount), ref)


def frames(spark, invoices, payments):
    return spark.createDataFrame(invoices, INVOICE), spark.createDataFrame(payments, PAYMENT)


def random_stage(spark, rows=600, customers=40, seed=7):
    """Stage rows with every class, NULL classes, days on window edges and after the reference."""
    rng = random.Random(seed)
    timing = [*CLASSES[0][1], None]
    amount = [*CLASSES[1][1], "PAGAMENTO_MINIMO", "SEM_PAGAMENTO", None]
    edges = [date(2024, 1, 1), date(2023, 11, 1), date(2023, 8, 1), date(2023, 5, 1), date(2023, 2, 1)]

    def day():
        kind = rng.random()
        if kind < 0.05:
            return None
        if kind < 0.3:
            return rng.choice(edges) + timedelta(days=rng.choice((-1, 0, 1)))
        return date(2022, 12, 1) + timedelta(days=rng.randrange(450))

    def money():
        return Decimal(rng.randrange(10**7)) / 100 if rng.random() > 0.1 else None

    data = [
        (
            rng.randrange(customers) if rng.random() > 0.02 else None, RUN_TS, rng.choice(timing),
            day(), money(), money(), money(), rng.choice(amount),
            rng.random() * 100 if rng.random() > 0.1 else None,
            rng.randrange(-9, 40) if rng.random() > 0.1 else None, 1, 202402,
        )
        for _ in range(rows)
    ]
    # a customer outside every window and one without classes
    data.append((900, RUN_TS, timing[0], date(2020, 1, 1), money(), money(), money(), amount[0], 1.0, 1, 1, 202402))
    data.append((901, RUN_TS, None, date(2024, 1, 15), money(), money(), money(), None, 1.0, 1, 1, 202402))
    return spark.createDataFrame(data, STAGE)


