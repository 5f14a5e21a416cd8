"""Calendar columns, period keys and next-period arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time columns each level carries.
TIME_COLUMNS = {
    "none": (),
    "year": ("year",),
    "quarter": ("year", "quarter"),
    "month": ("year", "quarter", "month"),
}
ALL_TIME_COLUMNS = TIME_COLUMNS["month"]


def time_key(day: Column) -> Column:
    """YYYYMM as an integer."""
    return F.year(day) * 100 + F.month(day)


def period_label() -> Column:
    """`YYYY-MM` from the year and month columns."""
    return F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))


def quarter_of(month: int) -> int:
    return (month - 1) // 3 + 1


def next_period(
    year: int | None = None, quarter: int | None = None, month: int | None = None
) -> dict[str, int | None]:
    """The period after the given one, at its finest given level.

    The year moves only when it is given, and the quarter is recomputed when
    the month moves, so March of quarter 1 is followed by April of quarter 2.
    """
    if month is not None:
        following = month % 12 + 1
        return {
            "year": year + 1 if year is not None and following == 1 else year,
            "quarter": quarter_of(following) if quarter is not None or year is not None else None,
            "month": following,
        }
    if quarter is not None:
        following = quarter % 4 + 1
        return {
            "year": year + 1 if year is not None and following == 1 else year,
            "quarter": following,
            "month": None,
        }
    return {"year": year + 1 if year is not None else None, "quarter": None, "month": None}
