"""Ingestion text to typed raw rows: one projection per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN, INTENDED, check_mode, check_run_ts
from billbook.functions import text
from billbook.schema import INVOICE_KEYS, LINE, REJECTS

# Fixed values of `as_written`: a date pattern whose `mm` is minutes, so that
# every month reads as January, and an id window two characters wide.
MINUTES_PATTERN = "yyyy-mm-dd"
SHORT_ID = (3, 2)


def _run(run_ts: str | Column) -> Column:
    return F.lit(check_run_ts(run_ts)) if isinstance(run_ts, str) else run_ts


def standardize_invoices(df: DataFrame, run_ts: str | Column, mode: str = INTENDED) -> DataFrame:
    """`run_ts` is one timestamp for all rows, or a column with each row's."""
    literal = check_mode(mode) == AS_WRITTEN
    pattern = MINUTES_PATTERN if literal else text.ISO_DATE
    invoice = F.col("id_fatura")
    return df.select(
        (
            text.integer(F.substring(invoice, *SHORT_ID))
            if literal
            else text.number_after_hyphen(invoice)
        ).alias("id_fatura"),
        text.integer(F.col("id_cliente")).alias("id_cliente"),
        _run(run_ts).alias("dt_proc"),
        text.month_of(F.col("data_emissao")).alias("ref"),
        text.day(F.col("data_emissao"), pattern).alias("data_emissao"),
        text.day(F.col("data_vencimento"), pattern).alias("data_vencimento"),
        text.money(F.col("valor_fatura")).alias("valor_fatura"),
        text.money(F.col("valor_pagamento_minimo")).alias("valor_pagamento_minimo"),
    )


def standardize_payments(df: DataFrame, run_ts: str | Column, mode: str = INTENDED) -> DataFrame:
    """The same in both modes; `mode` is accepted so that callers can pass one setting."""
    check_mode(mode)
    return df.select(
        text.without_hyphens(F.col("id_pagamento")).alias("id_pagamento"),
        text.number_after_hyphen(F.col("id_fatura")).alias("id_fatura"),
        text.integer(F.col("id_cliente")).alias("id_cliente"),
        _run(run_ts).alias("dt_proc"),
        text.month_of(F.col("data_pagamento")).alias("ref"),
        text.day(F.col("data_pagamento")).alias("data_pagamento"),
        text.money(F.col("valor_pagamento")).alias("valor_pagamento"),
    )


STANDARDIZE = {"tb_faturas": standardize_invoices, "tb_pagamentos": standardize_payments}


def has_keys(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test


MALFORMED = "linha malformada"


def rejects(df: DataFrame, keys: Sequence[str] = INVOICE_KEYS) -> DataFrame:
    """Rows that no book can use, with the reason in `motivo`: a key is NULL, or the month is."""
    reason = F.when(~has_keys(keys), "sem chave").when(F.col("ref").isNull(), "sem mes")
    return df.withColumn("motivo", reason).where(F.col("motivo").isNotNull())


def rejected_lines(lines: DataFrame, name: str, run_ts: str | Column) -> DataFrame:
    """Malformed lines (`LINE`,) as rejects of the raw table `name`: their text, and NULL for the values."""
    known = {"dt_proc": _run(run_ts), "motivo": F.lit(MALFORMED), LINE: F.col(LINE)}
    return lines.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REJECTS[name]])
