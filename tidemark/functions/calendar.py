"""Date dimension and date parts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_parts(moment: Column) -> dict[str, Column]:
    """Partition columns of a date or timestamp."""
    return {"year": F.year(moment), "month": F.month(moment), "day": F.day(moment)}


def iso_weekday(day: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.dayofweek(day) + F.lit(5)) % F.lit(7) + F.lit(1)


def _describe(days: DataFrame) -> DataFrame:
    d = F.col("date")
    year, quarter, month = F.year(d), F.quarter(d), F.month(d)
    quarter_first = F.trunc(d, "quarter")
    return days.select(
        d,
        F.date_add(d, 1).alias("next_day_date"),
        year.alias("year"),
        F.concat(year, quarter).alias("year_quarter"),
        F.concat(year, month).alias("year_month"),
        F.concat(year, F.dayofyear(d)).alias("year_day_of_year"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter).alias("quarter_name"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.day(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "yyyy-MMMM").alias("year_month_name_long"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.last_day(d).alias("last_day_of_month"),
        # These two names are kept for existing users although they mark months.
        (F.day(d) == 1).alias("is_quarter_start"),
        (d == F.last_day(d)).alias("is_quarter_end"),
        (F.day(d) == 1).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == quarter_first).alias("is_first_day_of_quarter"),
        (d == F.last_day(F.add_months(quarter_first, 2))).alias("is_last_day_of_quarter"),
        F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year"),
    )


def date_dimension(
    spark: SparkSession,
    start_year: int,
    end_year: int | None = None,
    today: date | None = None,
) -> DataFrame:
    """One row per day from January 1st of ``start_year`` to December 31st of ``end_year``.

    ``end_year`` defaults to the year after ``today``.
    """
    if end_year is None:
        end_year = (today or date.today()).year + 1
    bounds = spark.range(1).select(
        F.lit(int(start_year)).alias("first_year"), F.lit(int(end_year)).alias("last_year")
    )
    return _between(bounds)


def date_dimension_of(df: DataFrame, column: str) -> DataFrame:
    """Date dimension over the full calendar years a date column of ``df`` touches."""
    year = F.year(F.col(f"`{column}`"))
    return _between(df.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year")))


def _between(bounds: DataFrame) -> DataFrame:
    first = F.make_date("first_year", F.lit(1), F.lit(1))
    last = F.make_date("last_year", F.lit(12), F.lit(31))
    return _describe(bounds.select(F.explode(F.sequence(first, last)).alias("date")))
