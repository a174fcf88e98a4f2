"""Reads of layered tables: snapshots, current versions, served days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingSnapshot(ValueError):
    """A day that a table must have is not there."""


def scoped(df: DataFrame, day: dt.date) -> DataFrame:
    """The day of a table that has days, else the current versions of one that has versions, else all."""
    if "cob_dt" in df.columns:
        return df.where(F.col("cob_dt") == F.lit(day))
    return df.where("is_current = 1") if "is_current" in df.columns else df


def assert_snapshots(tables: Mapping[str, DataFrame], day: dt.date) -> None:
    """Each table has rows of the day: a probe of one row each."""
    missing = [n for n, df in tables.items() if scoped(df, day).isEmpty()]
    if missing:
        raise MissingSnapshot(f"no rows of {day} in {', '.join(missing)}")


def serve_slice(df: DataFrame, day: dt.date) -> DataFrame:
    assert_snapshots({"table": df}, day)
    return scoped(df, day)


def assert_not_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df
