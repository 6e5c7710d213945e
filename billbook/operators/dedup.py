"""Latest version of each invoice or payment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook.config import AS_WRITTEN, INTENDED, check_mode
from billbook.operators.standardize import has_keys
from billbook.schema import INVOICE_KEYS, VERSION_ORDER

# Month (6 digits) and run timestamp (14 digits) side by side.
VERSION_TYPE = "decimal(20,0)"


def version_number(order: Sequence[str] = VERSION_ORDER) -> Column:
    """Month and run timestamp as one number, greater meaning later.

    A number rather than text keeps `max` over it in a hash aggregate; `max` of
    a string has to sort.
    """
    return F.concat(*[F.col(c).cast("string") for c in order]).try_cast(VERSION_TYPE)


def latest_key(
    df: DataFrame, keys: Sequence[str] = INVOICE_KEYS, order: Sequence[str] = VERSION_ORDER
) -> DataFrame:
    """Greatest version per key. Aggregates before it shuffles, so a hot key stays cheap."""
    return df.groupBy(*keys).agg(
        F.max(version_number(order)).cast("string").alias("max_dedup_key")
    )


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = INVOICE_KEYS,
    order: Sequence[str] = VERSION_ORDER,
    mode: str = INTENDED,
) -> DataFrame:
    """Rows of the greatest `order` per key, ties kept; rows with a NULL key are left out.

    Plans as one shuffle with a group limit on both sides of it, and leaves the
    rows partitioned by `keys`, which a following join on them reuses. A key
    whose *tied* rows alone would overload a task should be salted first: see
    `billbook.plans.stage.latest_versions`.

    `as_written` keeps every version, and turns each group with a NULL in its
    key into a single all-NULL row.
    """
    if check_mode(mode) == AS_WRITTEN:
        blank = (
            df.where(~has_keys(keys))
            .select(*keys)
            .distinct()
            .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
        )
        return df.where(has_keys(keys)).unionByName(blank)
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        df.where(has_keys(keys))
        .withColumn("_rank", F.rank().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
