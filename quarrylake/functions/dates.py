"""Calendar with fiscal periods and parsing of dates that differ by source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """yyyyMMdd as a number."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def fiscal_year(c: Column, first_month: int = 4) -> Column:
    """Year in which the fiscal year of the day begins."""
    return F.year(c) - F.when(F.month(c) < first_month, 1).otherwise(0)


def parse_by_source(text: Column, source: Column, formats: Mapping[str, str]) -> Column:
    """Date by the source's own format, else ISO; null where it can't be read (never an error)."""
    out = F.lit(None).cast("date")
    for name, fmt in formats.items():
        out = F.when(source == name, F.try_to_date(text, fmt)).otherwise(out)
    return F.coalesce(out, F.try_to_date(text, "yyyy-MM-dd"))


def calendar(spark: SparkSession, start: str, end: str, first_month: int = 4, holidays: DataFrame | None = None, monsoon: tuple[int, ...] = (6, 7, 8, 9)) -> DataFrame:
    """One row a day from start to end: calendar and fiscal parts, weekend, monsoon, holiday (several names of a day are joined)
    and working day (neither weekend nor holiday; holiday_name is null without a table of them)."""
    days = spark.sql(f"SELECT explode(sequence(date'{start}', date'{end}', interval 1 day)) AS day")
    d = F.col("day")
    fy = fiscal_year(d, first_month)
    month = F.pmod(F.month(d) - F.lit(first_month), F.lit(12)) + 1
    out = days.select(
        date_key(d).alias("date_sk"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day_of_month"), F.dayofweek(d).alias("day_of_week"),
        F.weekofyear(d).alias("week"), F.dayofyear(d).alias("day_of_year"), F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"), F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"),
        F.concat(F.lit("FY"), fy, F.lit("-"), F.lpad(F.pmod(fy + 1, F.lit(100)).cast("string"), 2, "0")).alias("fiscal_year"), F.floor((month + 2) / 3).cast("int").alias("fiscal_quarter"), month.alias("fiscal_month"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.month(d).isin(*monsoon).alias("is_monsoon"),
    )
    if holidays is None:
        out = out.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        names = holidays.groupBy(F.col("holiday_date").cast("date").alias("day")).agg(F.array_join(F.sort_array(F.collect_set("holiday_name")), " / ").alias("holiday_name"))
        out = out.join(names, "day", "left")
    return out.withColumn("is_working_day", ~F.col("is_weekend") & F.col("holiday_name").isNull())
