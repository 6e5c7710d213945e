"""Books of several reference dates from one scan of the raw tables.

A date sees of every invoice and payment the latest version that its months of look-back hold, so
a version is in force for an interval of months: from its own to the one before the next version's, and no longer
than the look-back. Invoices join what is in force of their payments; a month in which nothing is, is unpaid.

Issue dates fall into *slices*, the intervals between the window starts of all dates. Rows are combined by customer,
classes, slice and the dates they are in force for, before they travel. From these partial
aggregates any window of any date is composed: it is a run of slices. What depends on the date itself, the
days since an unpaid invoice was due, is kept as days since a fixed day and shifted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.config import as_date, month_bounds, window_start
from billbook.functions.payment import UNPAID
from billbook.operators import skew
from billbook.operators.standardize import has_keys
from billbook.plans.book import (
    CELL, class_numbers, feature_book, finished, merged, partials, wide_book,
)
from billbook.plans.spec import BookSpec
from billbook.plans.stage import TIMING, build_stage, payment_variables, stage_columns
from billbook.schema import INVOICE_KEYS, STAGE
from billbook.sources.lake import in_months

DAYS = "fvl_numero_dias_atraso"
EPOCH = date(1970, 1, 1)
RUN = "dt_proc"
EVER = 10**6  # more months than any calendar has

FIRST, LAST, SLICE, SINCE, COUNTED = "_first", "_last", "_slice", "_since", "_days_n"


def feature_books(
    invoices: DataFrame,
    payments: DataFrame,
    ref_dates: Sequence[date | str],
    run_ts: str,
    spec: BookSpec = BookSpec(),
    rows_per_task: int | None = skew.ROWS_PER_TASK,
    payment_keys: Sequence[str] = INVOICE_KEYS,
) -> DataFrame:
    """The books of all `ref_dates`, at most one a month, as one frame with `ref` telling them apart.

    The same rows as `feature_book` of `build_stage` for each date and its look-back months. Each raw table is
    read and shuffled once. If a key has more than `rows_per_task` rows, or payments are told apart by further
    keys, every date is computed on its own instead, which spreads such keys.
    """
    dates = sorted({as_date(d) for d in ref_dates})
    if not dates or len({(d.year, d.month) for d in dates}) < len(dates):
        raise ValueError("reference dates are one or more, and one a month at most")
    if "ref" not in spec.group_keys:
        raise ValueError("books of several dates need ref among the group keys")
    bounds = [month_bounds(d, max(spec.windows)) for d in dates]
    tables = [in_months(t, bounds[0][0], bounds[-1][1]) for t in (invoices, payments)]
    if set(payment_keys) != set(INVOICE_KEYS) or _any_hot(tables, rows_per_task):
        return reduce(DataFrame.unionByName, [
            feature_book(
                build_stage(*[in_months(t, *b) for t in tables], d, run_ts, rows_per_task=rows_per_task, payment_keys=payment_keys),
                spec, d,
            )
            for d, b in zip(dates, bounds)
        ])
    rows = rows_in_force(*tables, dates, run_ts, max(spec.windows))
    # The run is the same for all rows. As a grouping key it would be folded, and hide that rows lie as they must.
    grouped = replace(spec, group_keys=tuple(k for k in spec.group_keys if k != RUN))
    books = wide_book(_cells(rows, grouped, dates), grouped)
    names = [*spec.group_keys, *books.columns[len(grouped.group_keys):]]
    return books.selectExpr(*[f"'{run_ts}' as {RUN}" if n == RUN else n for n in names])


def _any_hot(tables: Sequence[DataFrame], rows_per_task: int | None) -> bool:
    if rows_per_task is None:
        return False
    large = [t for t in tables if t.count() > rows_per_task]
    return any(not skew.find_hot_keys(t, rows_per_task=rows_per_task).isEmpty() for t in large)


def in_force(df: DataFrame, look_back: int, gaps: bool = False) -> DataFrame:
    """Rows of a raw table with `_from` and `_to`, the months (counted from year 0) whose dates see them; the others are left out.

    With `gaps` there are also rows for the months in which no version of a key is in force: `_held` is false there,
    and true for all others. Together the rows of a key then cover all time.
    """
    newest_first = Window.partitionBy(*INVOICE_KEYS).orderBy(F.desc("ref"), F.desc("dt_proc"))
    ties = Window.partitionBy(*INVOICE_KEYS, "ref", "dt_proc")
    month = F.expr("cast(ref div 100 * 12 + ref % 100 as int)")
    later = F.lag(F.struct("ref", "dt_proc")).over(newest_first)
    marked = df.where(has_keys(INVOICE_KEYS) & F.col("ref").isNotNull()).withColumn("_month", month).withColumns({
        # Of equal versions one stands for all of them.
        "_leads": later.isNull() | (later != F.struct("ref", "dt_proc")),
        "_next": F.lag("_month").over(newest_first),
        "_oldest": F.lead("_month").over(newest_first).isNull(),
    })
    until = F.coalesce(F.max(F.when(F.col("_leads"), F.col("_next"))).over(ties) - 1, F.lit(EVER))
    timed = marked.withColumn("_until", until).withColumn("_to", F.least("_until", F.col("_month") + look_back))

    def piece(first: Column, last: Column, held: bool) -> Column:
        return F.struct(first.alias("_from"), last.alias("_to"), F.lit(held).alias("_held"))

    pieces = F.array(piece(F.col("_month"), F.col("_to"), True))
    if gaps:
        after = F.when(F.col("_leads"), piece(F.col("_to") + 1, F.col("_until"), False))
        before = F.when(F.col("_oldest"), piece(F.lit(-EVER), F.col("_month") - 1, False))
        pieces = F.array_compact(F.array(piece(F.col("_month"), F.col("_to"), True), after, before))
    cut = timed.select(*df.columns, F.explode(pieces).alias("_piece"))
    return cut.select(*df.columns, "_piece.*").where("_from <= _to")


def rows_in_force(
    invoices: DataFrame, payments: DataFrame, dates: Sequence[date], run_ts: str, look_back: int
) -> DataFrame:
    """Stage rows with `FIRST` and `LAST`, the places in `dates` of those that see them.

    Days late of unpaid invoices count to `EPOCH`.
    """
    paid = in_force(payments, look_back, gaps=True).select(
        *INVOICE_KEYS, F.when(F.col("_held"), F.col("data_pagamento")).alias("data_pagamento"),
        F.when(F.col("_held"), F.col("valor_pagamento")).alias("valor_pagamento"),
        F.col("_from").alias("_paid_from"), F.col("_to").alias("_paid_to"),
    ).alias("p")
    billed = in_force(invoices, look_back).alias("i")
    same = reduce(Column.__and__, [F.col(f"i.{k}") == F.col(f"p.{k}") for k in INVOICE_KEYS])
    together = same & (F.col("_from") <= F.col("_paid_to")) & (F.col("_paid_from") <= F.col("_to"))
    joined = billed.join(paid, together, "left")
    first = F.greatest("_from", F.coalesce("_paid_from", "_from"))
    last = F.least("_to", F.coalesce("_paid_to", "_to"))
    months = F.array(*[F.lit(d.year * 12 + d.month) for d in dates])
    placed = joined.select(
        "i.id_fatura", "i.id_cliente", "data_emissao", "data_vencimento", "valor_fatura",
        "valor_pagamento_minimo", "data_pagamento", "valor_pagamento",
        F.size(F.filter(months, lambda m: m < first)).alias(FIRST),
        (F.size(F.filter(months, lambda m: m <= last)) - 1).alias(LAST),
    ).where(F.col(FIRST) <= F.col(LAST))
    return stage_columns(payment_variables(placed, EPOCH), EPOCH, run_ts, FIRST, LAST)


def _cells(rows: DataFrame, spec: BookSpec, dates: Sequence[date]) -> DataFrame:
    """What `book_cells` returns, for all dates."""
    starts = [[window_start(d, n) for n in spec.windows] for d in dates]
    ends = [d + timedelta(days=1) for d in dates]
    bounds = sorted({s for own in starts for s in own} | (set() if spec.include_after_ref else set(ends)))
    place = {b: i + 1 for i, b in enumerate(bounds)}
    day = F.col(spec.date_column)
    codes = [f"_class{i}" for i in range(len(spec.classes))]
    keys = [k for k in spec.group_keys if k != "ref"]
    sliced = rows.select(
        *keys, *[n.alias(c) for n, c in zip(class_numbers(spec), codes)],
        F.when(day.isNotNull(), F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= day))).alias(SLICE),
        FIRST, LAST, (F.col(TIMING) == UNPAID).alias(SINCE), *[m for m, _ in spec.measures],
    )
    types = {m: STAGE[m].dataType for m, _ in spec.measures}
    counted = [F.count(DAYS).alias(COUNTED)] if DAYS in dict(spec.measures) else []
    few = sliced.groupBy(*keys, *codes, SLICE, FIRST, LAST, SINCE).agg(*partials(spec, types), *counted)
    values = [c for c in few.columns if c not in (*keys, *codes, SLICE, FIRST, LAST, SINCE, COUNTED)]

    at = F.col("_date") + 1
    by_date = few.repartition(*[F.col(k) for k in keys]).withColumn("_date", F.explode(F.sequence(FIRST, LAST)))
    ref = F.element_at(F.array(*[F.lit(d.year * 100 + d.month) for d in dates]), at)
    shift = F.when(F.col(SINCE), F.element_at(F.array(*[F.lit((d - EPOCH).days) for d in dates]), at)).otherwise(0)
    firsts = F.element_at(F.array(*[F.array(*[F.lit(place[s]) for s in own]) for own in starts]), at)
    outside = F.col(SLICE).isNull()
    if not spec.include_after_ref:
        outside = outside | (F.col(SLICE) >= F.element_at(F.array(*[F.lit(place[e]) for e in ends]), at))
    # Windows that begin after the slice; the others, all longer ones, contain it.
    band = F.when(outside, len(spec.windows)).otherwise(F.size(F.filter(firsts, lambda s: F.col(SLICE) < s)))
    shown = by_date.select(
        *[ref.alias(k) if k == "ref" else F.col(k) for k in spec.group_keys], *codes, band.alias("_band"),
        *[_moved(v, shift).alias(v) for v in values],
    )
    width = len(spec.windows)
    runs = [
        F.when(
            F.col(c).isNotNull() & (F.col("_band") < width),
            F.sequence(F.col(c) * width + F.col("_band"), F.col(c) * width + (width - 1)),
        ).otherwise(F.array().cast("array<int>"))
        for c in codes
    ]
    per_cell = (
        shown.select(*spec.group_keys, F.explode_outer(F.concat(*runs)).alias(CELL), *values)
        .groupBy(*spec.group_keys, CELL)
        .agg(*merged(spec, types))
    )
    return per_cell.select(*spec.group_keys, CELL, *finished(spec, types))


def _moved(name: str, shift: Column) -> Column:
    """A partial aggregate, of days moved by `shift`."""
    value = F.col(name)
    if name == f"{DAYS}_sum":
        return value + F.col(COUNTED) * shift
    if name in (f"{DAYS}_max", f"{DAYS}_min"):
        return (value + shift).cast("int")
    return value
