from datetime import date

from tidemark.functions.calendar import date_dimension

# The row of 2022-01-01.
NEW_YEAR = {
    "date": date(2022, 1, 1), "next_day_date": date(2022, 1, 2), "year": 2022, "year_quarter": "20221",
    "year_month": "20221", "year_day_of_year": "20221", "quarter": 1, "quarter_name": "Q1", "month": 1,
    "month_name": "January", "month_abbr": "Jan", "day": 1, "day_name": "Saturday", "day_of_week": 6,
    "week_of_year": 52, "year_month_name_long": "2022-January", "is_weekend": True,
    "last_day_of_month": date(2022, 1, 31), "is_quarter_start": True, "is_quarter_end": False,
}


def test_rows_per_year(spark):
    counts = {r["year"]: r["count"] for r in date_dimension(spark, 2022, 2024).groupBy("year").count().collect()}
    assert counts == {2022: 365, 2023: 365, 2024: 366}


def test_default_end_is_next_year(spark):
    found = date_dimension(spark, 2022, today=date(2025, 6, 1)).selectExpr("min(date)", "max(date)", "count(distinct year)").first()
    assert tuple(found) == (date(2022, 1, 1), date(2026, 12, 31), 5)


def test_golden_row(spark):
    row = date_dimension(spark, 2022, 2022).where("date = date'2022-01-01'").first().asDict()
    assert {k: row[k] for k in NEW_YEAR} == NEW_YEAR
    assert list(row)[:20] == list(NEW_YEAR)
    assert row["iso_year"] == 2021


def test_quarter_flags_and_month_flags_differ(spark):
    df = date_dimension(spark, 2023, 2023)
    assert df.where("is_quarter_start").count() == 12 and df.where("is_month_start").count() == 12
    assert df.where("is_first_day_of_quarter").count() == 4 and df.where("is_last_day_of_quarter").count() == 4
    assert df.where("is_last_day_of_quarter and date = date'2023-06-30'").count() == 1
