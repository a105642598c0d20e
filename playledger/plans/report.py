"""Reports: the recap suite as text, for one or more dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from playledger.functions.clock import AsOf
from playledger.operators.report import body, cards, sections
from playledger.plans.recap import recap_tables, report_days
from playledger.star import Star


def report_sections(star: Star, as_of: Sequence[AsOf]) -> DataFrame:
    """Section texts of one report per day; a day that is given twice has one."""
    dates = list(as_of)
    recaps = recap_tables(star, dates)
    return sections(cards(recaps), report_days(recaps.sparkSession, dates))


def report_bodies(star: Star, as_of: Sequence[AsOf]) -> DataFrame:
    """Report text of each date: ``as_of, body``."""
    return body(report_sections(star, as_of))
