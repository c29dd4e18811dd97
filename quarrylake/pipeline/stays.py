"""Wards by day: who is there, who comes and goes, and how full it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.text import surrogate_key
from ..operators.intervals import expand_days

#: From which share of its beds a ward is called what.
BANDS = ((0.95, "Critical 95%+"), (0.85, "High 85-95%"), (0.60, "Normal 60-85%"))
HIGH = 0.85


def capacities(wards: DataFrame | None, segments: DataFrame, place: Sequence[str], bed: str | None = None) -> DataFrame:
    """(place, bed_count): as the wards' table says or, where there is none, how many different beds were seen."""
    if wards is not None:
        return wards.select(*place, "bed_count")
    if bed is None:
        raise ValueError("without a table of wards the column of the bed is needed")
    return segments.groupBy(*place).agg(F.count_distinct(bed).alias("bed_count"))


def ward_days(segments: DataFrame, beds: DataFrame, place: Sequence[str], who: str) -> DataFrame:
    """(place, day) with occupied_beds (different persons), open_stays, admissions, discharges (closed stays only), mean_stay of
    the segments that end on the day (days inclusive), occupancy_rate, turnover_rate and is_over_capacity.

    segments: place, who, start_date, end_date, is_open. One pass: each segment gives a row for each of its days with what
    happens on it; persons are first counted by (place, day, who), so that a ward with a third of all stays is spread over its
    persons. Capacities are joined to days, not to stays. Null persons count as no bed; segments without days as nothing.
    """
    parts = segments.select(*place, F.col(who).alias("__who"), "start_date", "end_date", "is_open")
    last = F.col("day") == F.col("end_date")
    rows = expand_days(parts, "start_date", "end_date")
    rows = rows.withColumns({"__in": (F.col("day") == F.col("start_date")).cast("int"), "__out": (last & ~F.col("is_open")).cast("int"), "__end": last.cast("int"), "__days": F.when(last, F.datediff("end_date", "start_date") + 1).otherwise(0)})
    one = rows.groupBy(*place, "day", "__who").agg(F.max("__in").alias("i"), F.max("__out").alias("o"), F.sum("__end").alias("e"), F.sum("__days").alias("d"), F.sum(F.col("is_open").cast("int")).alias("open"))
    there = F.col("__who").isNotNull().cast("int")
    day = one.groupBy(*place, "day").agg(
        F.count("__who").alias("occupied_beds"), F.sum("open").alias("open_stays"), F.sum(F.col("i") * there).alias("admissions"), F.sum(F.col("o") * there).alias("discharges"),
        F.round(F.sum("d") / F.nullif(F.sum("e"), F.lit(0)), 2).alias("mean_stay"),
    )
    rate = lambda c: F.when(F.col("bed_count") > 0, F.round(F.col(c) / F.col("bed_count"), 4))
    out = day.join(beds, list(place), "left")
    return out.withColumns({"occupancy_rate": rate("occupied_beds"), "turnover_rate": rate("discharges")}).withColumn("is_over_capacity", F.col("occupancy_rate") > 1.0)


def occupancy_band(rate: Column) -> Column:
    """Name of the band of a rate; 'Unknown' without one."""
    out = F.when(rate.isNull(), "Unknown")
    for least, name in BANDS:
        out = out.when(rate >= least, name)
    return out.otherwise("Low <60%")


def fact_bed_occupancy(days: DataFrame, place: Sequence[str]) -> DataFrame:
    """ward_days with keys, band and whether it is high."""
    keys = {"bed_occupancy_sk": surrogate_key([*[F.col(c) for c in place], F.col("day")]), "hospital_sk": surrogate_key([F.col("hospital_id")]), "date_sk": date_key(F.col("day"))}
    return days.withColumns(keys | {"occupancy_band": occupancy_band(F.col("occupancy_rate")), "is_high_occupancy": F.coalesce(F.col("occupancy_rate") >= HIGH, F.lit(False))})
