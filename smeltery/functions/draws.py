"""Draws that depend only on (row id, seed, column name).

Unlike ``rand`` they come out the same for any partitioning and after any task retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _below(n: int | Column, row_id: str, seed: int, name: str) -> Column:
    bound = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.xxhash64(F.col(row_id), F.lit(seed), F.lit(name)), bound.cast("long"))


def whole(low: int, high: int, row_id: str, seed: int, name: str) -> Column:
    """Uniform over the whole numbers low..high, both included."""
    return _below(high - low + 1, row_id, seed, name) + F.lit(low).cast("long")


def money(low: int, high: int, row_id: str, seed: int, name: str) -> Column:
    """Uniform over low..high in steps of 0.01, as a double."""
    return whole(low * 100, high * 100, row_id, seed, name) / F.lit(100.0)


def pick(values: Sequence[str], row_id: str, seed: int, name: str) -> Column:
    choices = F.array(*(F.lit(v) for v in values))
    return F.element_at(choices, whole(1, len(values), row_id, seed, name).cast("int"))
