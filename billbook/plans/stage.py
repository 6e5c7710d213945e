"""The stage table: latest invoices with their payments and the payment variables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN, INTENDED, as_date, check_mode, check_run_ts
from billbook.functions import payment
from billbook.operators import skew
from billbook.operators.dedup import dedup_latest
from billbook.operators.join import join_payments, join_payments_salted
from billbook.operators.standardize import has_keys
from billbook.schema import INVOICE_KEYS

TIMING = "fbc_classificacao_dias_pagamento"
AMOUNT = "fbc_classificacao_vlr_pagamento"


def latest_versions(
    df: DataFrame, mode: str = INTENDED, rows_per_task: int | None = skew.ROWS_PER_TASK
) -> DataFrame:
    """`dedup_latest` of one table, salting keys whose latest rows would overload a task."""
    if check_mode(mode) == AS_WRITTEN or rows_per_task is None or df.count() <= rows_per_task:
        return dedup_latest(df, mode=mode)
    cells = skew.plan_cells(
        skew.find_hot_keys(df, rows_per_task=rows_per_task), None, INVOICE_KEYS, rows_per_task
    )
    if cells.isEmpty():
        return dedup_latest(df)
    spread = skew.salted(df, cells, "left")
    return dedup_latest(spread, (*INVOICE_KEYS, skew.SALT)).drop(skew.SALT, skew.COPIED)


def latest_joined(
    invoices: DataFrame,
    payments: DataFrame,
    mode: str = INTENDED,
    rows_per_task: int | None = skew.ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> DataFrame:
    """Deduplicate both tables and join them.

    Two shuffles in all: each table is shuffled once for its deduplication and
    the join reuses both layouts. If a table has more than `rows_per_task` rows, keys
    with more than that are searched first, without a shuffle of the others, and salted
    through the same plan if there are any; None skips the search.

    `payment_keys` tell payments apart. By default a later payment of an invoice
    replaces an earlier one; with `id_pagamento` among the keys only versions of
    the same payment do, and instalments stay. They include the invoice's keys.
    """
    if not set(INVOICE_KEYS) <= set(payment_keys):
        raise ValueError(f"payment_keys must include {INVOICE_KEYS}")
    by_payment = set(payment_keys) != set(INVOICE_KEYS)
    cells = None
    if rows_per_task is not None and any(t.count() > rows_per_task for t in (invoices, payments)):
        hot = [skew.find_hot_keys(t, rows_per_task=rows_per_task) for t in (invoices, payments)]
        cells = skew.plan_cells(*hot, INVOICE_KEYS, rows_per_task)
    every = check_mode(mode) == AS_WRITTEN
    if not every and (cells is None or cells.isEmpty()):
        if by_payment:
            # Laid out by invoice, which serves the finer keys and then the join.
            payments = payments.repartition(*[F.col(k) for k in INVOICE_KEYS])
        return join_payments(dedup_latest(invoices), dedup_latest(payments, payment_keys))

    if every:
        # All versions of both sides; the all-NULL rows of the payments match no invoice.
        invoices = dedup_latest(invoices, mode=mode)
        payments = payments.where(has_keys(INVOICE_KEYS))
    if cells is None:
        none = [skew.find_hot_keys(t.limit(0)) for t in (invoices, payments)]
        cells = skew.plan_cells(*none, INVOICE_KEYS, skew.ROWS_PER_TASK)
    left = skew.salted(invoices, cells, "left", all_versions=every)
    right = skew.salted(
        payments, cells, "right", all_versions=every or by_payment,
        place_by=payment_keys if by_payment else None,
    )
    if not every:
        left = dedup_latest(left, (*INVOICE_KEYS, skew.SALT))
        if by_payment:
            right = right.repartition(*[F.col(k) for k in (*INVOICE_KEYS, skew.SALT)])
        right = dedup_latest(right, (*payment_keys, skew.SALT))
    return join_payments_salted(left, right)


def payment_variables(joined: DataFrame, ref_date: date | str, mode: str = INTENDED) -> DataFrame:
    """`joined` with timing class, days late, amount class and percent paid."""
    paid_on, due_on = F.col("data_pagamento"), F.col("data_vencimento")
    paid, total = F.col("valor_pagamento"), F.col("valor_fatura")
    return (
        joined.withColumn(TIMING, payment.timing_class(paid_on, due_on))
        .withColumn(
            "fvl_numero_dias_atraso", payment.days_late(F.col(TIMING), paid_on, due_on, ref_date)
        )
        .withColumn(AMOUNT, payment.amount_class(paid, F.col("valor_pagamento_minimo"), total))
        .withColumn("fvl_pct_fatura_pgto", payment.pct_paid(F.col(AMOUNT), paid, total, mode))
    )


def stage_columns(variables: DataFrame, ref_date: date | str, run_ts: str, *further: str) -> DataFrame:
    """Project to the stage schema, and `further` columns. `ref` is the month of the reference date."""
    return variables.select(
        "id_cliente",
        F.lit(int(f"{as_date(ref_date):%Y%m}")).alias("ref"),
        F.lit(check_run_ts(run_ts)).alias("dt_proc"),
        TIMING,
        "data_emissao",
        F.col("valor_fatura").alias("fvl_valor_fatura"),
        F.col("valor_pagamento_minimo").alias("fvl_valor_pagamento_minimo"),
        F.col("valor_pagamento").alias("fvl_valor_pagamento"),
        AMOUNT,
        F.col("fvl_pct_fatura_pgto").cast("float").alias("fvl_pct_fatura_pgto"),
        "fvl_numero_dias_atraso",
        F.lit(1).alias("fvl_qtd_transacao"),
        *further,
    )


def build_stage(
    invoices: DataFrame,
    payments: DataFrame,
    ref_date: date | str,
    run_ts: str,
    mode: str = INTENDED,
    rows_per_task: int | None = skew.ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> DataFrame:
    """Stage rows from raw invoices and payments already limited to the look-back months."""
    joined = latest_joined(invoices, payments, mode, rows_per_task, payment_keys)
    return stage_columns(payment_variables(joined, ref_date, mode), ref_date, run_ts)
