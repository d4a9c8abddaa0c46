"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_attributes(d: str | Column) -> dict[str, Column]:
    """Calendar columns of a date, named as in the date dimension.

    day_of_week is 0 = Sunday … 6 = Saturday (D4); week_of_year is the ISO
    week (X14); month_name / day_name are full English names (D5); a weekend
    is Saturday or Sunday (D3); year_month is ``yyyy-MM``.
    """
    c = F.col(d) if isinstance(d, str) else d
    dow = F.dayofweek(c) - 1
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "quarter": F.quarter(c),
        "day_of_week": dow,
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "month_name": F.date_format(c, "MMMM"),
        "day_name": F.date_format(c, "EEEE"),
        "is_weekend": dow.isin(0, 6),
        "year_month": F.date_format(c, "yyyy-MM"),
    }
