"""The feature book: per customer, aggregates of each measure by class and window.

Windows are cumulative and a row has one class per class column, so a variable is
an aggregate over one *cell* (class, window). The plan is:

1. Aggregate by customer, classes and *band*, the shortest window holding a row.
   Partial aggregation runs before the shuffle, so of a customer of any size at
   most 180 rows per task travel, and 180 in all go on.
2. Shuffle these by customer; every later step stays in that layout.
3. Repeat each row into the cells that contain it, its own window and the longer
   ones, and aggregate per cell.
4. Per customer, collect its cells (35 at most) in a map and read each variable
   from it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billbook.functions.calendar import window_band, window_flags
from billbook.plans.spec import CATALOG_COLUMNS, BookSpec, Variable, expand
from billbook.schema import STAGE

CELL = "_cell"
BAND = "_band"


def feature_book(stage: DataFrame, spec: BookSpec, ref_date: date | str) -> DataFrame:
    """One row per customer, one column per variable; an empty cell is NULL."""
    return wide_book(book_cells(stage, spec, ref_date), spec)


def wide_book(cells: DataFrame, spec: BookSpec) -> DataFrame:
    """The book from what `book_cells` returns."""
    numbers = _cell_numbers(spec)
    # As text: building hundreds of Column objects one by one takes seconds on the driver.
    columns = [f"`{k}`" for k in spec.group_keys] + [
        f"_cells[{numbers[v.class_column, v.class_value, v.months]}].`{_slot(v)}` as {v.name}"
        for v in expand(spec)
    ]
    values = F.struct(*[c for c in cells.columns if c not in (*spec.group_keys, CELL)])
    cell_map = F.map_from_entries(
        F.collect_list(F.when(F.col(CELL).isNotNull(), F.struct(F.col(CELL), values)))
    )
    return cells.groupBy(*spec.group_keys).agg(cell_map.alias("_cells")).selectExpr(*columns)


def feature_book_long(stage: DataFrame, spec: BookSpec, ref_date: date | str) -> DataFrame:
    """One row per customer and variable that has a value, as double.

    Skips the last step of the wide book. Doubles lose cents above 2**53; the
    wide book keeps exact types.
    """
    cells = book_cells(stage, spec, ref_date).where(F.col(CELL).isNotNull())
    slots = [c for c in cells.columns if c not in (*spec.group_keys, CELL)]
    melted = cells.select(
        *spec.group_keys,
        CELL,
        F.posexplode(F.array(*[F.col(s).cast("double") for s in slots])).alias("_slot", "value"),
    ).where(F.col("value").isNotNull())
    numbers = _cell_numbers(spec)
    names = stage.sparkSession.createDataFrame(
        [
            (
                numbers[v.class_column, v.class_value, v.months], slots.index(_slot(v)),
                v.name, v.class_column, v.class_value, v.measure, v.months, v.aggregate,
            )
            for v in expand(spec)
        ],
        f"{CELL} int, _slot int, {CATALOG_COLUMNS}",
    )
    # One row per variable of the spec, whatever the size of the data.
    return melted.join(F.broadcast(names), [CELL, "_slot"]).drop(CELL, "_slot")


def feature_book_direct(stage: DataFrame, spec: BookSpec, ref_date: date | str) -> DataFrame:
    """The book as one conditional aggregate per variable.

    Simple, and several times slower: every row updates every variable. Kept to
    check `feature_book` against.
    """
    day = F.col(spec.date_column)
    flags = window_flags(day, ref_date, spec.windows, spec.include_after_ref)
    flagged = stage.withColumns(flags)
    return flagged.groupBy(*spec.group_keys).agg(*[
        F.expr(
            f"{v.aggregate}(case when {v.class_column} = '{v.class_value}' "
            f"and flg_u{v.months}m = 1 then {v.measure} end) as {v.name}"
        )
        for v in expand(spec)
    ])


def book_cells(stage: DataFrame, spec: BookSpec, ref_date: date | str) -> DataFrame:
    """One row per customer and cell with a column per (measure, aggregate).

    Rows outside every cell leave their customer with a row whose cell is NULL.
    """
    codes = [f"_class{i}" for i in range(len(spec.classes))]
    banded = _banded(stage, spec, ref_date, codes)
    types = {m: stage.schema[m].dataType for m, _ in spec.measures}
    rows = banded.groupBy(*spec.group_keys, *codes, BAND).agg(*partials(spec, types))
    values = [c for c in rows.columns if c not in (*spec.group_keys, *codes, BAND)]
    per_cell = (
        rows.repartition(*[F.col(k) for k in spec.group_keys])
        .select(*spec.group_keys, F.explode_outer(_cells_of(spec, codes)).alias(CELL), *values)
        .groupBy(*spec.group_keys, CELL)
        .agg(*merged(spec, types))
    )
    return per_cell.select(*spec.group_keys, CELL, *finished(spec, types))


def _banded(stage: DataFrame, spec: BookSpec, ref_date: date | str, codes: list[str]) -> DataFrame:
    """Classes as small numbers, NULL when the row has no class of the spec or no window."""
    band = window_band(
        F.col(spec.date_column), ref_date, spec.windows, spec.include_after_ref
    )
    coded = [
        F.when(band.isNotNull(), number).alias(name) for name, number in zip(codes, class_numbers(spec))
    ]
    return stage.select(
        *spec.group_keys, *coded, band.alias(BAND), *[m for m, _ in spec.measures]
    )


def class_numbers(spec: BookSpec) -> list[Column]:
    """For each class column the number of the row's class over all of the spec, NULL if it has none."""
    out, first = [], 0
    for column, values in spec.classes:
        out.append(F.coalesce(*[
            F.when(F.col(column) == value, F.lit(first + i)) for i, value in enumerate(values)
        ]))
        first += len(values)
    return out


def _cells_of(spec: BookSpec, codes: list[str]) -> Column:
    """The cells holding a band: its own window and every longer one, per class."""
    width = len(spec.windows)
    runs = [
        F.when(
            F.col(c).isNotNull(),
            F.sequence(F.col(c) * width + F.col(BAND), F.col(c) * width + (width - 1)),
        ).otherwise(F.array().cast("array<int>"))
        for c in codes
    ]
    return F.concat(*runs)


def _cell_numbers(spec: BookSpec) -> dict[tuple[str, str, int], int]:
    cells = [(c, v, m) for c, values in spec.classes for v in values for m in spec.windows]
    return {cell: i for i, cell in enumerate(cells)}


def book_schema(spec: BookSpec) -> T.StructType:
    """The columns of a written book, `ref` last."""
    empty = SparkSession.active().createDataFrame([], STAGE)
    fields = feature_book(empty, spec, "2000-01-01").schema.fields
    return T.StructType([f for f in fields if f.name != "ref"] + [STAGE["ref"]])


def _slot(v: Variable) -> str:
    return f"{v.measure}_{v.aggregate}"


def _parts(aggregates: tuple[str, ...], kind: T.DataType) -> list[str]:
    """What the aggregates of a measure are rebuilt from."""
    total = [f"sum{i}" for i in range(len(LIMBS))] + ["odd"] if _floating(kind) else ["sum"]
    needs = {"SUM": total, "AVG": [*total, "n"], "MAX": ["max"], "MIN": ["min"]}
    return list(dict.fromkeys(p for a in aggregates for p in needs[a]))


def partials(spec: BookSpec, types: dict[str, T.DataType]) -> list[Column]:
    """Per band: what the requested aggregates can be rebuilt from."""
    out = []
    for measure, aggregates in spec.measures:
        value = F.col(measure)
        made = {"sum": F.sum(value), "n": F.count(value), "max": F.max(value), "min": F.min(value)}
        if _floating(types[measure]):
            limbs, odd = _limbs(value.cast("double"))
            made |= {f"sum{i}": F.sum(limb) for i, limb in enumerate(limbs)} | {"odd": F.sum(odd)}
        out += [made[p].alias(f"{measure}_{p}") for p in _parts(aggregates, types[measure])]
    return out


def merged(spec: BookSpec, types: dict[str, T.DataType]) -> list[Column]:
    combine = {"max": F.max, "min": F.min}
    return [
        combine.get(part, F.sum)(f"{measure}_{part}").alias(f"{measure}_{part}")
        for measure, aggregates in spec.measures
        for part in _parts(aggregates, types[measure])
    ]


# A sum of floating numbers depends on their order. So each is cut into whole numbers of 24 bits, of these powers of
# two, whose sums do not. Bits below the last power are left out of every number alike; percentages
# have none.
LIMBS = (24, 0, -24, -48, -72)
# Numbers from here on, and those that are not finite, are summed as they are.
LARGE = 2.0**50


def _floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _limbs(value: Column) -> tuple[list[Column], Column]:
    """Whole numbers that times 2 to the power of `LIMBS` make up the value, and the value if it is too large for it."""
    plain = F.abs(value) < LARGE  # not so for NaN, which is larger than any number
    limbs, rest = [], F.when(plain, value) / 2.0 ** LIMBS[0]
    for _ in LIMBS:
        whole = F.floor(rest)
        limbs.append(whole)
        rest = (rest - whole) * 2.0**24
    return limbs, F.when(~plain, value)


def _total(measure: str) -> Column:
    """The sum that the sums of limbs stand for, NULL if there was no value."""
    total = F.lit(0.0)
    for i in reversed(range(len(LIMBS))):
        total = total / 2.0**24 + F.col(f"{measure}_sum{i}").cast("double")
    total = total * 2.0 ** LIMBS[0]
    odd = F.col(f"{measure}_odd")
    return F.when(odd.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + odd)


def finished(spec: BookSpec, types: dict[str, T.DataType]) -> list[Column]:
    """The aggregates, with the types Spark gives them on the unmerged rows."""
    out = []
    for measure, aggregates in spec.measures:
        sum_type, avg_type = _sum_type(types[measure]), _avg_type(types[measure])
        total = _total(measure) if _floating(types[measure]) else F.col(f"{measure}_sum")
        n = F.col(f"{measure}_n")
        exact = isinstance(avg_type, T.DecimalType)
        for aggregate in aggregates:
            if aggregate == "SUM":
                value = total.try_cast(sum_type)
            elif aggregate == "AVG":
                dividend = total if exact else total.cast("double")
                divisor = n.cast("decimal(20,0)") if exact else n.cast("double")
                value = F.try_divide(dividend, divisor).try_cast(avg_type)
            else:
                value = F.col(f"{measure}_{aggregate.lower()}")
            out.append(value.alias(f"{measure}_{aggregate}"))
    return out


def _sum_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DecimalType(min(38, t.precision + 10), t.scale)
    return T.DoubleType() if isinstance(t, (T.FloatType, T.DoubleType)) else T.LongType()


def _avg_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DecimalType(min(38, t.precision + 4), min(38, t.scale + 4))
    return T.DoubleType()
