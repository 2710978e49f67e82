"""Public holidays and clock changes."""

from __future__ import annotations

from datetime import date, timedelta

from dateutil.easter import easter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.session import small_table

# Fixed values: (month, day) holidays, holidays as days after Easter Sunday, and the years covered.
HOLIDAY_RULES = {
    "spain_demand": {
        "fixed": [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)],
        "easter": [-2],
        "years": (2015, 2018),
    },
    "rte_france": {
        "fixed": [(1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)],
        "easter": [1, 39, 50],
        "years": (2014, 2024),
    },
}
DST_YEARS = (2014, 2024)


def holiday_dates(dataset_id: str) -> list[date]:
    rule = HOLIDAY_RULES.get(dataset_id)
    if rule is None:
        return []
    first, last = rule["years"]
    days = set()
    for year in range(first, last + 1):
        days.update(date(year, month, day) for month, day in rule["fixed"])
        days.update(easter(year) + timedelta(days=shift) for shift in rule["easter"])
    return sorted(days)


def holiday_calendar(spark: SparkSession) -> DataFrame:
    """(dataset_id, holiday): a few hundred rows, whatever the data size."""
    rows = [(name, day) for name in HOLIDAY_RULES for day in holiday_dates(name)]
    return small_table(spark, rows, "dataset_id string, holiday date")


def is_eu_clock_change(ts: Column, years: tuple[int, int] | None = DST_YEARS) -> Column:
    """01:00 to 03:59 UTC on the last Sunday of March and October."""
    day = F.to_date(ts)
    last_sunday = F.next_day(F.date_sub(F.last_day(day), 7), "Sun")
    hit = F.month(ts).isin(3, 10) & (day == last_sunday) & F.hour(ts).between(1, 3)
    return hit & F.year(ts).between(*years) if years else hit
