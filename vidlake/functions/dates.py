"""Date column expressions. Dates are literal calendar dates: no time zone
is applied, so the session zone cannot move a video to another day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType


def lenient_date(text: Column) -> Column:
    """ISO date or timestamp text to its calendar date; NULL for other text."""
    return text.try_cast("date")


def publish_date(df: DataFrame) -> Column:
    """The publish date as a date. A column that is one already is used as it
    is, so that a filter on it reaches the files."""
    published = F.col("published_date")
    typed = isinstance(df.schema["published_date"].dataType, DateType)
    return published if typed else lenient_date(published)


def date_parts(date: Column) -> dict[str, Column]:
    """The integer partition columns of a date."""
    return {"year": F.year(date), "month": F.month(date), "day": F.day(date)}


def path_parts(date: Column) -> dict[str, Column]:
    """The same as zero-padded text, for directory names."""
    return {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }


def day_label() -> Column:
    """Unpadded y-m-d label from the part columns; NULL for a NULL day."""
    text = [F.col(part).cast("string") for part in ("year", "month", "day")]
    return F.concat(text[0], F.lit("-"), text[1], F.lit("-"), text[2])


def days_before(run_date: dt.date, days: int) -> Column:
    """The first calendar date of a window reaching back from the run date."""
    return F.date_sub(F.lit(run_date), days)


def run_date_text(run_date: dt.date) -> Column:
    """The run date as it is stamped on records: yyyy-MM-dd."""
    return F.date_format(F.lit(run_date), "yyyy-MM-dd")
