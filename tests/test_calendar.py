from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from billbook.config import Zones, check_run_ts, month_bounds, window_start
from billbook.functions.calendar import WINDOWS, window_band, window_flags


def test_month_bounds():
    assert month_bounds("2024-02-01") == (202302, 202402)
    assert month_bounds(date(2023, 12, 31), 12) == (202212, 202312)
    assert month_bounds("2024-01-15", 1) == (202312, 202401)


def test_run_ts_is_fixed_width():
    assert Zones("r").ingestion_run("tb_faturas", "20240201080000") == (
        "r/00_ingestion/tb_faturas/tb_faturas_20240201_20240201080000"
    )
    for bad in ("2024", "20240201 80000", "202402010800000"):
        with pytest.raises(ValueError):
            check_run_ts(bad)


def test_window_start_equals_months_between(spark):
    """Every day of 2022-2024 against every reference day of a leap and a common year."""
    refs = [date(2023, 1, 1) + timedelta(days=i) for i in range(731)]
    starts = [(r, n, window_start(r, n)) for r in refs for n in WINDOWS]
    days = spark.sql("select explode(sequence(date'2021-12-01', date'2025-01-31')) as day")
    wrong = (
        spark.createDataFrame(starts, "ref date, n int, start date")
        .join(days, F.col("day").between(F.date_sub("start", 45), F.date_add("start", 45)))
        .where((F.months_between("ref", "day") <= F.col("n")) != (F.col("day") >= F.col("start")))
    )
    assert wrong.count() == 0


FLAGS = {
    date(2024, 1, 1): (1, 1, 1, 1, 1),
    date(2023, 12, 31): (0, 1, 1, 1, 1),
    date(2023, 11, 1): (0, 1, 1, 1, 1),
    date(2023, 2, 1): (0, 0, 0, 0, 1),
    date(2023, 1, 31): (0, 0, 0, 0, 0),
    date(2024, 2, 10): (1, 1, 1, 1, 1),
    None: (0, 0, 0, 0, 0),
}


def test_flags(spark):
    df = spark.createDataFrame([(d,) for d in FLAGS], "day date")
    rows = df.withColumns(window_flags(F.col("day"), "2024-02-01")).collect()
    assert {r["day"]: tuple(r[f"flg_u{n}m"] for n in WINDOWS) for r in rows} == FLAGS


def test_after_reference_can_be_left_out(spark):
    df = spark.createDataFrame([(date(2024, 2, 10),), (date(2024, 2, 1),)], "day date")
    rows = df.select("day", window_flags(F.col("day"), "2024-02-01", (1,), False)["flg_u1m"].alias("f"))
    assert {r["day"].day: r["f"] for r in rows.collect()} == {10: 0, 1: 1}


def test_band_is_first_flag(spark):
    df = spark.createDataFrame([(d,) for d in FLAGS], "day date")
    rows = df.withColumn("band", window_band(F.col("day"), "2024-02-01")).collect()
    expected = {d: (f.index(1) if 1 in f else None) for d, f in FLAGS.items()}
    assert {r["day"]: r["band"] for r in rows} == expected
