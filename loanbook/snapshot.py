"""The two as-of dates of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from loanbook.functions.casting import safe_date


def _as_date(value: dt.date | str) -> Column:
    if isinstance(value, dt.date):
        return F.lit(value)
    return safe_date(F.lit(value))


@dataclass(frozen=True)
class Snapshot:
    """``data_referencia`` dates the indicators and limits which payments are
    visible; ``data_corte`` is the day arrears are measured on. They are set
    apart from each other and each falls back to today.

    A ``data_referencia`` text that is no date stays NULL (nothing is visible);
    a ``data_corte`` text that is no date falls back to today.
    """

    data_referencia: dt.date | str | None = None
    data_corte: dt.date | str | None = None

    @property
    def reference(self) -> Column:
        if self.data_referencia is None:
            return F.current_date()
        return _as_date(self.data_referencia)

    @property
    def cut(self) -> Column:
        if self.data_corte is None:
            return F.current_date()
        return F.coalesce(_as_date(self.data_corte), F.current_date())

    def pinned(self, spark: SparkSession) -> Snapshot:
        """The same snapshot with "today" resolved once, so that a run of many
        jobs cannot straddle midnight."""
        row = spark.range(1).select(self.reference.alias("r"), self.cut.alias("c")).first()
        return Snapshot(row.r if row.r is not None else "", row.c)
