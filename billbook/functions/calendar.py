"""Look-back windows before a reference date.

Windows are cumulative (the last month lies inside the last three), so a row is
described fully by its *band*: the position of the shortest window holding it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from billbook.config import as_date, window_start

# Window lengths in months: fixed values behind the names u1m .. u12m.
WINDOWS = (1, 3, 6, 9, 12)


def in_window(
    day: Column, ref_date: date | str, months: int, include_after_ref: bool = True
) -> Column:
    """Is `day` at most `months` months before `ref_date`? NULL day gives NULL.

    Days after the reference date are inside every window unless
    `include_after_ref` is off.
    """
    test = day >= F.lit(window_start(ref_date, months))
    return test if include_after_ref else test & (day <= F.lit(as_date(ref_date)))


def window_flags(
    day: Column,
    ref_date: date | str,
    windows: Sequence[int] = WINDOWS,
    include_after_ref: bool = True,
) -> dict[str, Column]:
    """`flg_u{n}m` columns, 1 inside the window and 0 outside or for a NULL day."""
    return {
        f"flg_u{n}m": F.when(in_window(day, ref_date, n, include_after_ref), 1).otherwise(0)
        for n in windows
    }


def window_band(
    day: Column,
    ref_date: date | str,
    windows: Sequence[int] = WINDOWS,
    include_after_ref: bool = True,
) -> Column:
    """Index into ascending `windows` of the shortest one holding `day`, else NULL."""
    return F.coalesce(*[
        F.when(in_window(day, ref_date, n, include_after_ref), F.lit(i))
        for i, n in enumerate(windows)
    ])
