"""Sizes at which a plan changes its form. Every form gives the same rows."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """Bounds that are checked on the data before the lean form of a plan is used.

    tests_per_group    rows one task may sort as a single group
    samples_per_group  values one exact percentile aggregate may hold
    rows_per_task      rows one task should sort, where their number is known
    """

    tests_per_group: int = 1_000_000
    samples_per_group: int = 1_000_000
    rows_per_task: int = 300_000


DEFAULT = Limits()
