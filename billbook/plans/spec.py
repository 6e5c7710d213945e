"""What the book contains: a declarative list of variables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import count, product

from pyspark.sql import DataFrame, SparkSession

from billbook.functions.calendar import WINDOWS
from billbook.functions.payment import (
    BELOW_MINIMUM, EARLY, FULL, LATE, ON_TIME, PARTIAL, UNPAID,
)
from billbook.plans.stage import AMOUNT, TIMING

# The classes with variables, in numbering order.
CLASSES = (
    (TIMING, (UNPAID, LATE, ON_TIME, EARLY)),
    (AMOUNT, (BELOW_MINIMUM, FULL, PARTIAL)),
)

# The measures in numbering order, each with the aggregates that
# make sense for it. Days and percentages are not summed; the count only is.
MEASURES = (
    ("fvl_valor_fatura", ("SUM", "AVG", "MAX", "MIN")),
    ("fvl_valor_pagamento_minimo", ("SUM", "AVG", "MAX", "MIN")),
    ("fvl_valor_pagamento", ("SUM", "AVG", "MAX", "MIN")),
    ("fvl_numero_dias_atraso", ("AVG", "MAX", "MIN")),
    ("fvl_qtd_transacao", ("SUM",)),
    ("fvl_pct_fatura_pgto", ("AVG", "MAX", "MIN")),
)

CATALOG_COLUMNS = (
    "variable string, class_column string, class_value string, measure string, "
    "months int, aggregate string"
)


@dataclass(frozen=True)
class Variable:
    name: str
    class_column: str
    class_value: str
    measure: str
    months: int
    aggregate: str


@dataclass(frozen=True)
class BookSpec:
    """Classes x measures x windows x aggregates.

    `sum_only_windows` keeps only SUM in those windows; `no_measure` lists
    (class column, class, measure) without variables. `include_after_ref` lets
    rows dated after the reference date count in every window.
    """

    classes: tuple[tuple[str, tuple[str, ...]], ...] = CLASSES
    measures: tuple[tuple[str, tuple[str, ...]], ...] = MEASURES
    windows: tuple[int, ...] = WINDOWS
    sum_only_windows: tuple[int, ...] = ()
    no_measure: tuple[tuple[str, str, str], ...] = ()
    include_after_ref: bool = True
    group_keys: tuple[str, ...] = ("id_cliente", "ref", "dt_proc")
    date_column: str = "data_emissao"

    def __post_init__(self) -> None:
        if list(self.windows) != sorted(set(self.windows)):
            raise ValueError("windows must ascend")

    def documented(self) -> BookSpec:
        """The stricter variant: one month keeps only SUM, and classes whose
        percentage is constant have none."""
        return replace(
            self,
            sum_only_windows=(1,),
            no_measure=(
                (TIMING, UNPAID, "fvl_pct_fatura_pgto"),
                (AMOUNT, FULL, "fvl_pct_fatura_pgto"),
            ),
        )


def expand(spec: BookSpec = BookSpec()) -> list[Variable]:
    """All variables, numbered from 1 by class, measure, window, aggregate."""
    numbers = count(1)
    return [
        Variable(f"VAR_{next(numbers)}", column, value, measure, months, aggregate)
        for column, values in spec.classes
        for value, (measure, aggregates) in product(values, spec.measures)
        if (column, value, measure) not in spec.no_measure
        for months, aggregate in product(spec.windows, aggregates)
        if aggregate == "SUM" or months not in spec.sum_only_windows
    ]


def catalog(spark: SparkSession, spec: BookSpec = BookSpec()) -> DataFrame:
    """`expand` as a table, to join with the long book. One row per variable."""
    rows = [
        (v.name, v.class_column, v.class_value, v.measure, v.months, v.aggregate)
        for v in expand(spec)
    ]
    return spark.createDataFrame(rows, CATALOG_COLUMNS)
