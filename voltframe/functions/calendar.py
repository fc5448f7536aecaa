"""Calendar features (hour, Monday=0 weekday, month, weekend flag, season)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import col_

# Month -> season mapping (Dec-Feb winter, Mar-May spring,
# Jun-Aug summer, every other month - including a missing one - fall).
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)
WEEKEND_DAYS = (5, 6)  # Saturday, Sunday with Monday = 0


def day_of_week(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6 (``dayofweek`` would be Sunday = 1)."""
    return F.weekday(col_(ts)).cast("int")


def is_weekend(dow: str | Column) -> Column:
    return col_(dow).isin(*WEEKEND_DAYS).cast("int")


def season(month: str | Column) -> Column:
    m = col_(month)
    return (F.when(m.isin(*WINTER_MONTHS), F.lit("winter"))
            .when(m.isin(*SPRING_MONTHS), F.lit("spring"))
            .when(m.isin(*SUMMER_MONTHS), F.lit("summer"))
            .otherwise(F.lit("fall")))


def calendar_columns(ts: str | Column) -> dict[str, Column]:
    t = col_(ts)
    dow = day_of_week(t)
    month = F.month(t).cast("int")
    return {
        "hour": F.hour(t).cast("int"),
        "day_of_week": dow,
        "month": month,
        "is_weekend": is_weekend(dow),
        "season": season(month),
    }


def add_calendar_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour, day_of_week (Mon=0), month, is_weekend (0/1), season."""
    return df.withColumns(calendar_columns(ts))
