"""Date attributes used by the date dimension and fact keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: str | Column) -> Column:
    """yyyyMMdd as INT."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyyMMdd").cast("int")


def date_attributes(c: str | Column) -> list[Column]:
    """date_key, date, year, month, month_name, quarter, day_of_week
    (1 = Sunday), is_weekend (Saturday or Sunday)."""
    d = F.col(c) if isinstance(c, str) else c
    dow = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        dow.alias("day_of_week"),
        F.when(dow.isin(1, 7), 1).otherwise(0).alias("is_weekend"),
    ]
