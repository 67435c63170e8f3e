"""Dates as the feeds write them, and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barlake.functions.columns import col_of


# a whole date, and nothing behind it but a time of day with an optional zone
_WHOLE_DAY = r"^([0-9]{8}|[0-9]{4}-[0-9]{2}-[0-9]{2})([T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"


def day(text: Column | str) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` (also with a time part) to a date; otherwise NULL.

    The whole text has to have that form: longer digit runs and one-digit months are NULL.
    The digits are laid out for the plain date cast, which handles bad text without the
    exception per row that a format parser raises inside."""
    whole = F.trim(col_of(text))
    digits = F.substring(F.replace(whole, F.lit("-"), F.lit("")), 1, 8)
    parts = [F.substring(digits, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    return F.when(whole.rlike(_WHOLE_DAY), F.concat_ws("-", *parts).try_cast("date"))


def request_day(text: Column | str, as_of: Column | str) -> Column:
    """Like :func:`day`, where the word ``today`` (any case) stands for ``as_of``."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.when(F.lower(col_of(text)) == "today", as_of).otherwise(day(text))


def calendar_parts(date_column: Column | str) -> dict[str, Column]:
    """Weekday (Monday = 0), ISO week, month and year."""
    d = col_of(date_column)
    return {
        "day_of_week": F.weekday(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
    }


def business_days(start: Column | str, end: Column | str) -> Column:
    """Number of Mondays to Fridays in [start, end]; 0 if the range is empty.

    Closed form over whole weeks, so a row costs the same whatever the range."""
    start, end = col_of(start), col_of(end)

    def weekdays_up_to(d: Column) -> Column:
        # of the n days since Monday 1969-12-29, without the Saturdays and Sundays
        n = F.datediff(d, F.lit("1969-12-28").cast("date"))
        return n - F.floor((n + 1) / 7) - F.floor(n / 7)

    count = weekdays_up_to(end) - weekdays_up_to(F.date_sub(start, 1))
    # the formula runs backwards for an empty range; unknown bounds stay unknown
    return F.when(start <= end, count).when(start > end, F.lit(0))
