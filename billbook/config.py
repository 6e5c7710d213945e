"""Lake layout and calendar arithmetic. Everything here runs on the driver on scalars."""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass
from datetime import date, timedelta

# How the load and book functions treat the known gaps between intent and code
# of the scripts this library replaces (see README, "Modes").
INTENDED = "intended"
AS_WRITTEN = "as_written"

# Ending of the name of a table's copy that is clustered by customer.
BY_CUSTOMER = "_por_cliente"


def check_mode(mode: str) -> str:
    if mode not in (INTENDED, AS_WRITTEN):
        raise ValueError(f"mode must be {INTENDED!r} or {AS_WRITTEN!r}, not {mode!r}")
    return mode


def check_run_ts(run_ts: str) -> str:
    """Run timestamps are `yyyyMMddHHmmss`: fixed width, so text order is time order."""
    if not re.fullmatch(r"\d{14}", run_ts):
        raise ValueError(f"run_ts must be yyyyMMddHHmmss, not {run_ts!r}")
    return run_ts


def as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Zones:
    """Paths of one lake. `root` is any URI Spark can read."""

    root: str

    def ingestion(self, table: str) -> str:
        return f"{self.root}/00_ingestion/{table}"

    def ingestion_run(self, table: str, run_ts: str) -> str:
        check_run_ts(run_ts)
        return f"{self.ingestion(table)}/{table}_{run_ts[:8]}_{run_ts}"

    def raw(self, table: str) -> str:
        return f"{self.root}/01_raw/{table}"

    def rejects(self, table: str) -> str:
        return f"{self.root}/01_raw/rejeitados_{table}"

    def curated(self, table: str) -> str:
        return f"{self.root}/02_curated/{table}"

    def versions(self, table: str, buckets: int) -> str:
        return f"{self.root}/02_curated/ultimas_{table}_{buckets}"

    def sliced(self, table: str, slices: int) -> str:
        return f"{self.root}/02_curated/fatias_{slices}/{table}"

    def control(self, table: str) -> str:
        return f"{self.root}/03_controle/controle_{table}"

    def stream_state(self, table: str) -> str:
        return f"{self.root}/_stream_state/{table}"


def _back(day: date, months: int) -> tuple[int, int]:
    index = day.year * 12 + day.month - 1 - months
    return index // 12, index % 12 + 1


def month_bounds(ref_date: date | str, months: int = 12) -> tuple[int, int]:
    """First and last `yyyyMM` of the look-back, both inclusive."""
    ref_date = as_date(ref_date)
    year, month = _back(ref_date, months)
    return year * 100 + month, ref_date.year * 100 + ref_date.month


def window_start(ref_date: date | str, months: int) -> date:
    """Earliest date `d` for which `months_between(ref_date, d) <= months`.

    A literal date keeps the window test a plain comparison that reaches the scan.
    Two month ends count as whole months apart; otherwise a reference day the
    target month lacks pushes the start into the following month.
    """
    ref_date = as_date(ref_date)
    year, month = _back(ref_date, months)
    last = calendar.monthrange(year, month)[1]
    if ref_date.day <= last:
        return date(year, month, ref_date.day)
    month_end = date(year, month, last)
    if ref_date.day == calendar.monthrange(ref_date.year, ref_date.month)[1]:
        return month_end
    return month_end + timedelta(days=1)
