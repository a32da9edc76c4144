"""Day-folder layout of the four zones. Roots are any Hadoop file system URI."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from smeltery.schemas import MARTS

# The CSV files of a folder: those of a feed, and those that this library has written, packed ones too.
CSV_FILES = "{*.csv,part-*.csv.gz}"


def as_run_date(value: dt.date | str) -> dt.date:
    """One run date for every layer; text must be a valid ``YYYY-MM-DD``."""
    return value if isinstance(value, dt.date) else dt.datetime.strptime(value, "%Y-%m-%d").date()


def day(run_date: dt.date | str) -> str:
    return as_run_date(run_date).strftime("%Y%m%d")


@dataclass(frozen=True)
class Zones:
    raw: str
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, root: str) -> Zones:
        root = root.rstrip("/")
        return cls(*(f"{root}/{zone}_landing_zone" for zone in ("raw", "bronze", "silver", "gold")))

    @classmethod
    def from_config(cls, paths: Mapping[str, str]) -> Zones:
        """From the ``paths`` section of a pipeline config."""
        keys = ("output_folder", "bronze_folder", "silver_folder", "gold_folder")
        return cls(*(paths[key].rstrip("/") for key in keys))

    def raw_day(self, table: str, run_date: dt.date | str) -> str:
        return f"{self.raw}/raw_{table}/{day(run_date)}"

    def bronze_table(self, table: str, run_date: dt.date | str) -> str:
        return f"{self.bronze}/bronze_{table}/{day(run_date)}/{table}"

    def silver_table(self, table: str, run_date: dt.date | str) -> str:
        return f"{self.silver}/silver_{table}/{day(run_date)}/{table}"

    def rejected_table(self, table: str, run_date: dt.date | str) -> str:
        """Rows of the day that did not reach silver."""
        return f"{self.silver}/rejected_{table}/{day(run_date)}/{table}"

    def gold_table(self, table: str, run_date: dt.date | str) -> str:
        return f"{self.gold}/{MARTS[table]}/{day(run_date)}/{table}"

    def log(self, layer: str, run_date: dt.date | str) -> str:
        """Where the runs of a layer's day are recorded; scans of the zone pass over it."""
        return f"{getattr(self, layer)}/_runs/{day(run_date)}"
