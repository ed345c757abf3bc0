"""Joining a fitted table back to the rows it was fitted on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A fitted table of so few rows goes to all tasks.
FEW = 10_000


def lookup(df: DataFrame, model: DataFrame, on: Sequence[str] | str | Column, how: str = "left") -> DataFrame:
    """Join with a fitted table; the planner sends it to all tasks if it turns out small, and splits hot keys."""
    return df.join(model, on, how)


def lookup_codes(df: DataFrame, model: DataFrame, on: str) -> DataFrame:
    """Left join with a small or large table of values, read from a checkpoint.

    All rows of one value meet in one task of a plain join, so a column of a
    few values would be read by as many tasks. A table of at most ``FEW`` rows
    is sent to the rows instead.
    """
    few = model.limit(FEW + 1).count() <= FEW
    return df.join(F.broadcast(model) if few else model, on, "left")
