"""From events to segments, days and daily state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def segments(events: DataFrame, key: str, ts: str, unique: str, kind: str, entries: Sequence[str], as_of: str, cap_days: int = 45) -> DataFrame:
    """A segment for each entry event, up to the next event of the key of any kind.

    Without one it is open: it ends at the earlier of cap_days later and as_of, and is flagged. Ends are never before starts.
    Days are inclusive. Null keys or times are dropped.
    """
    w = Window.partitionBy(key).orderBy(ts, unique)
    rows = events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("__next", F.lead(ts).over(w)).filter(F.col(kind).isin(*entries))
    start = F.to_date(ts)
    end = F.coalesce(F.to_date("__next"), F.least(F.date_add(start, cap_days), F.lit(as_of).cast("date")))
    return rows.withColumns({"start_date": start, "end_date": F.greatest(start, end), "is_open": F.col("__next").isNull()}).drop("__next")


def expand_days(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row for each day from start to end, both included; rows with a null or reversed period have none."""
    return df.filter(F.col(start) <= F.col(end)).withColumn(day, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))))


def open_on_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """(day, n_open) for every day from the first start to the last end on which any period is open, both ends included.

    Periods become a step up and a step down, summed by day before anything is ordered, and the running sum goes over the
    days only: at most one row a day of the calendar whatever the number and length of the periods. Null or reversed
    periods are left out.
    """
    steps = F.array(F.struct(F.col(start).alias("day"), F.lit(1).alias("step")), F.struct(F.date_add(end, 1).alias("day"), F.lit(-1).alias("step")))
    by_day = df.filter(F.col(start) <= F.col(end)).select(F.inline(steps)).groupBy("day").agg(F.sum("step").alias("step"))
    w = Window.orderBy("day")
    level = by_day.select("day", F.sum("step").over(w).alias("n_open"), F.date_sub(F.lead("day").over(w), 1).alias("__last"))
    return expand_days(level.filter("n_open > 0").withColumnRenamed("day", "__first"), "__first", "__last").select("day", "n_open")


def daily_state(parts: DataFrame, place: str, who: str) -> DataFrame:
    """(place, day): distinct `who` present, open segments, starts, ends of closed ones and mean days of those.

    One pass: each segment gives a row for each of its days with what happens on it. Distinct persons are counted by first
    grouping on (place, day, who), so that a busy place is spread over its persons.
    """
    rows = expand_days(parts, "start_date", "end_date").withColumns({
        "__in": (F.col("day") == F.col("start_date")).cast("int"),
        "__out": ((F.col("day") == F.col("end_date")) & ~F.col("is_open")).cast("int"),
        "__days": F.datediff("end_date", "start_date") + 1,
    })
    one = rows.groupBy(place, "day", who).agg(F.sum(F.col("is_open").cast("int")).alias("o"), F.sum("__in").alias("i"), F.sum("__out").alias("x"), F.sum(F.col("__out") * F.col("__days")).alias("d"))
    return one.groupBy(place, "day").agg(
        F.count(who).alias("present"), F.sum("o").alias("open_segments"), F.sum("i").alias("starts"), F.sum("x").alias("ends"),
        F.round((F.sum("d") / F.nullif(F.sum("x"), F.lit(0))).cast("double"), 4).alias("mean_days"),
    )
