"""Rounding, means and ratios with the output's conventions, as SQL expression texts."""

from __future__ import annotations


def quoted(name: str) -> str:
    return f"`{name}`"


def steady_round(value: str, digits: int) -> str:
    """Round half up, after removing the noise of floating-point summation.

    A mean depends in its last bits on the order in which partitions are merged.
    Without the first rounding an exact tie such as 12.3425 could go either way.
    """
    return f"round(round({value}, 9), {digits})"


def plain_round(value: str, digits: int) -> str:
    """Round half up, once: for values that are picked, not computed."""
    return f"round({value}, {digits})"


def log_mean(value: str, condition: str = "true") -> str:
    """Geometric mean; values of zero or less are ignored."""
    return f"pow(10D, avg(CASE WHEN {condition} AND {value} > 0 THEN log10({value}) END))"


def share(condition: str, of: str) -> str:
    return steady_round(f"try_divide(count_if({condition}), {of})", 3)
