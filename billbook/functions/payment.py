"""How an invoice was paid: timing class, days late, amount class, percent paid."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN, INTENDED, as_date, check_mode

# Class labels: fixed values stored in the stage and named by the book.
UNPAID = "SEM_PAGAMENTO"
LATE = "PAGAMENTO_ATRASADO"
ON_TIME = "PAGAMENTO_NO_PRAZO"
EARLY = "PAGAMENTO_ANTECIPADO"
BELOW_MINIMUM = "PAGAMENTO_INSUFICIENTE"
MINIMUM = "PAGAMENTO_MINIMO"
PARTIAL = "PAGAMENTO_PARCIAL"
FULL = "PAGAMENTO_TOTAL"

# Days late of an early payment: a marker, not the real lead.
EARLY_DAYS = -1


def timing_class(paid_on: Column, due_on: Column) -> Column:
    """Payment date against due date; NULL when paid but no due date is known."""
    return (
        F.when(paid_on.isNull(), UNPAID)
        .when(paid_on > due_on, LATE)
        .when(paid_on == due_on, ON_TIME)
        .when(paid_on < due_on, EARLY)
    )


def days_late(timing: Column, paid_on: Column, due_on: Column, ref_date: date | str) -> Column:
    """Days past due. Unpaid invoices count up to `ref_date`, negative if not yet due."""
    return (
        F.when(timing == UNPAID, F.datediff(F.lit(as_date(ref_date)), due_on))
        .when(timing == LATE, F.datediff(paid_on, due_on))
        .when(timing == ON_TIME, 0)
        .when(timing == EARLY, EARLY_DAYS)
    )


def amount_class(paid: Column, minimum: Column, total: Column) -> Column:
    """Amount paid against minimum and total, first match wins.

    Exactly the minimum is MINIMUM even when it is also the total; paying more
    than the total has no class.
    """
    return (
        F.when(paid.isNull(), UNPAID)
        .when(paid == minimum, MINIMUM)
        .when(paid < minimum, BELOW_MINIMUM)
        .when(paid == total, FULL)
        .when((paid > minimum) & (paid < total), PARTIAL)
    )


def pct_paid(amount: Column, paid: Column, total: Column, mode: str = INTENDED) -> Column:
    """Percent of the invoice paid; a zero invoice gives NULL.

    Unpaid is 0 and full payment is 100. `as_written` applies the division to
    every row, so an unpaid invoice is NULL.
    """
    ratio = F.try_divide(paid, total) * F.lit(100)
    if check_mode(mode) == AS_WRITTEN:
        return ratio
    return F.when(amount == UNPAID, 0).when(amount == FULL, 100).otherwise(ratio)
