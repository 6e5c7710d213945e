"""Keys too frequent for one task: finding them, and spreading their rows.

The rows of a join are the same whatever is found here. A key that is frequent on one
side is split over several cells there and copied to the same cells on the other side; a
key that is frequent on both is split on both, into a grid of cells in which every pair of
rows meets once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billbook.operators.dedup import VERSION_TYPE, version_number
from billbook.operators.standardize import has_keys
from billbook.schema import INVOICE_KEYS, VERSION_ORDER
from billbook.session import scratch_dir

SALT = "_salt"
COPIED = "_copied"

# About 1 GB of payment rows.
ROWS_PER_TASK = 10_000_000

# A task's frequent-items sketch: what Spark admits at most, and how many times the inverse of its size a key's
# share of the task's rows can be without being told from noise (twice the sketch's error of 3.5).
LARGEST_SKETCH = 1_000_000
UNSEEN = 7


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str] = INVOICE_KEYS,
    order: Sequence[str] = VERSION_ORDER,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(*keys, rows, latest): every key with more than `rows_per_task` rows; NULL keys are left out.

    Counts are exact, and only rows of `candidates` are counted: those keys are few, and one row per task after
    partial aggregation. `latest` is the greatest version number of the key. A table of no more rows than
    that, which Parquet tells from its footers, has no such key.
    """
    total = df.count()
    keyed = df.where(has_keys(keys)).withColumn(_HASH, F.xxhash64(*keys))
    if total <= rows_per_task:
        few = keyed.limit(0)
    else:
        few = keyed.join(F.broadcast(candidates(keyed, _HASH, total, rows_per_task)), _HASH, "leftsemi")
    return (
        few.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.max(version_number(order)).alias("latest"))
        .where(F.col("rows") > rows_per_task)
    )


_HASH = "_hash"


def candidates(df: DataFrame, column: str, total: int, rows_per_task: int) -> DataFrame:
    """(column,): values of a bigint column, every one with more than `rows_per_task` of the `total` rows among them.

    Each task sums its rows up in a frequent-items sketch and names the values that have more than a certain share of its
    rows. The share is such that what all tasks leave unnamed of a value is at most half of `rows_per_task`,
    so a value that has more rows is named for at least the other half of them. So at most
    2 * total / rows_per_task values are returned, and no value of a few rows leaves its task.

    A sketch has at most a million entries, enough for 71,000 times `rows_per_task` rows. In a larger table the
    limit grows with it, to 14 millionths of its rows.
    """
    size = min(max(2 * UNSEEN * total // rows_per_task, 1000), LARGEST_SKETCH)
    task = F.spark_partition_id().alias("_task")
    sketch = F.expr(f"approx_top_k({column}, {size // UNSEEN + 1}, {size})").alias("_top")
    tasks = df.groupBy(task).agg(sketch, F.count(F.lit(1)).alias("_rows"))
    named = tasks.select(F.explode("_top").alias("_item"), "_rows").where(
        F.col("_item.count") * size > F.col("_rows") * UNSEEN
    )
    found = named.groupBy(F.col("_item.item").alias(column)).agg(F.sum("_item.count").alias("_seen"))
    return found.where(F.col("_seen") * 2 > rows_per_task).select(column)


def plan_cells(
    left: DataFrame, right: DataFrame | None, keys: Sequence[str], rows_per_task: int
) -> DataFrame:
    """(*keys, left_splits, right_splits, left_latest, right_latest) of all hot keys, as a written table."""
    splits = F.ceil(F.col("rows") / rows_per_task).cast("int")
    sides = [
        hot.select(*keys, splits.alias(f"{side}_splits"), F.col("latest").alias(f"{side}_latest"))
        for side, hot in (("left", left), ("right", left.limit(0) if right is None else right))
    ]
    cells = reduce(lambda a, b: a.join(b, list(keys), "full"), sides)
    path = scratch_dir(cells.sparkSession, "hot")
    cells.write.parquet(path)
    return cells.sparkSession.read.schema(cells.schema).parquet(path)


def salted(
    df: DataFrame,
    cells: DataFrame,
    side: str,
    keys: Sequence[str] = INVOICE_KEYS,
    order: Sequence[str] = VERSION_ORDER,
    all_versions: bool = False,
    place_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add `SALT`, the cell, and `COPIED`, whether the row stands in several cells.

    `side` is left or right of `plan_cells`. A row of a hot key gets one of its own side's splits and is
    copied to all of the other side's. Rows that are not the latest version of a key that is hot on
    this side are dropped here, on the map side, so that deduplication per (key, cell) is deduplication
    per key; `all_versions` keeps them. Rows with a NULL key, which an outer join would send to one task
    although they match nothing, are spread too. Equal values of `place_by` share a split, for a later
    deduplication by further keys.
    """
    other = {"left": "right", "right": "left"}[side]
    # Differs between rows and, for identical rows, between input tasks; does not
    # depend on the order a task reads in, so a re-run places every row as before.
    place = F.xxhash64(*place_by) if place_by else F.xxhash64("_task", *df.columns)
    ways = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = df.withColumn("_task", F.spark_partition_id())
    # No broadcast is asked for: Spark decides by size, and splits hot keys of a shuffled join itself.
    found = marked.join(cells, list(keys), "left")
    if not all_versions:
        latest = F.col(f"{side}_latest").cast(VERSION_TYPE)
        found = found.where(latest.isNull() | (version_number(order) == latest))
    own, others = F.coalesce(f"{side}_splits", F.lit(1)), F.coalesce(f"{other}_splits", F.lit(1))
    split = F.pmod(place, own).cast("int")
    cell = _cell(side, split, own, others)
    hot = F.coalesce(f"{side}_splits", f"{other}_splits").isNotNull()
    ordinary = F.when(~has_keys(keys), F.pmod(place, F.lit(ways)).cast("int")).otherwise(0)
    return found.select(
        *df.columns,
        (others > 1).alias(COPIED),
        F.explode(F.when(hot, cell).otherwise(F.array(ordinary))).alias(SALT),
    )


def _cell(side: str, split: Column, own: Column, others: Column) -> Column:
    """All cells of a row: left splits are the rows of the grid, right splits its columns."""
    every = F.sequence(F.lit(0), others - 1)
    if side == "left":
        return F.transform(every, lambda x: split * others + x)
    return F.transform(every, lambda x: x * own + split)
