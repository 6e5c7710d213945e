"""Invoices with their payments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.operators.skew import COPIED, SALT
from billbook.schema import INVOICE_KEYS

JOINED = (
    "id_fatura", "id_cliente", "data_emissao", "data_vencimento",
    "valor_fatura", "valor_pagamento_minimo", "data_pagamento", "valor_pagamento",
)


def join_payments(
    invoices: DataFrame, payments: DataFrame, keys: Sequence[str] = INVOICE_KEYS
) -> DataFrame:
    """Left join: one row per invoice and payment, or one with NULLs if unpaid.

    An invoice with several payments repeats, so its total is counted once per
    payment further on.
    """
    paid = payments.select(*keys, "data_pagamento", "valor_pagamento")
    return invoices.join(paid, list(keys), "left").select(*JOINED)


def join_payments_salted(
    invoices: DataFrame, payments: DataFrame, keys: Sequence[str] = INVOICE_KEYS
) -> DataFrame:
    """`join_payments` of sides prepared by `skew.salted`.

    A copied invoice has its payments on some of its salts. Copies on the other
    salts found nothing and are dropped; the payments that made the key hot
    guarantee that at least one copy stays.
    """
    paid = payments.select(*keys, SALT, "data_pagamento", "valor_pagamento", F.lit(True).alias("_hit"))
    return (
        invoices.join(paid, [*keys, SALT], "left")
        .where(~F.col(COPIED) | F.col("_hit"))
        .select(*JOINED)
    )
