"""Averages of floating numbers: exact sums that do not depend on the order of rows."""

import math
import random
from fractions import Fraction

import numpy as np
from billing_rows import REF_DATE, random_stage
from pyspark.sql import functions as F

from billbook.plans.book import LIMBS, _limbs, _total, feature_book
from billbook.plans.spec import BookSpec


def _sum(spark, values, partitions=1):
    """The total of the limbs' sums, and how often the limbs alone make up the value."""
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    limbs, odd = _limbs(F.col("v"))
    sums = rows.agg(*[F.sum(x).alias(f"v_sum{i}") for i, x in enumerate(limbs)], F.sum(odd).alias("v_odd"))
    return sums.select(_total("v")).first()[0]


def test_sums_of_any_order_are_the_same_and_exact(spark):
    rng = random.Random(4)
    values = [float(np.float32(rng.choice([1, -1]) * rng.random() * 10 ** rng.randint(-12, 14))) for _ in range(3000)]
    exact = float(sum(map(Fraction, values)))
    found = set()
    for partitions in (1, 3, 8):
        rng.shuffle(values)
        found.add(_sum(spark, values, partitions))
    (total,) = found
    assert math.isclose(total, exact, rel_tol=1e-15)


def test_limbs_make_up_every_percentage(spark):
    values = [float(np.float32(v)) for v in (0.0, 100.0, 1e-13, 33.333333, 1e15, 12.5, 0.1, -7.3, 2.0**49)]
    limbs, _ = _limbs(F.col("v"))
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[x.alias(f"l{i}") for i, x in enumerate(limbs)])
    for r in rows.collect():
        assert sum(Fraction(r[f"l{i}"]) * Fraction(2) ** e for i, e in enumerate(LIMBS)) == Fraction(r.v)


def test_numbers_that_have_no_limbs(spark):
    assert _sum(spark, [None]) is None and _sum(spark, []) is None
    assert _sum(spark, [1e300, 1.0, None]) == 1e300 + 1.0
    assert _sum(spark, [float("inf"), 1.0]) == float("inf")
    assert math.isnan(_sum(spark, [float("nan"), 1.0]))


def test_the_book_is_the_same_under_any_partitioning(spark):
    stage = random_stage(spark, rows=800, customers=6).withColumn(
        "fvl_pct_fatura_pgto", (F.rand(3) * 117).cast("float")
    ).cache()
    books = [sorted(map(tuple, feature_book(stage.repartition(n), BookSpec(windows=(6, 12)), REF_DATE).collect()), key=str) for n in (1, 7)]
    assert books[0] == books[1]
