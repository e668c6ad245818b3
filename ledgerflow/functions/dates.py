"""Date arithmetic shared by the customer and account rules."""

from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Fixed value: a year is 365.25 days, so 365 days are still zero whole years.
DAYS_PER_YEAR = 365.25


def as_date(value: Column | date | str | None = None) -> Column:
    """A date column; ``None`` is the current date of the query."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_timestamp(value: Column | datetime | str | None = None) -> Column:
    """A timestamp column; ``None`` is the current timestamp of the query.

    Text and naive datetimes are read in the session time zone.
    """
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def days_since(column: str, as_of: Column) -> Column:
    return F.datediff(as_of, F.col(column))


def years_since(column: str, as_of: Column) -> Column:
    """Fractional years as a double."""
    return days_since(column, as_of) / F.lit(DAYS_PER_YEAR)


def whole_years_since(column: str, as_of: Column) -> Column:
    """Completed years as a bigint; null dates stay null."""
    return F.floor(years_since(column, as_of))
