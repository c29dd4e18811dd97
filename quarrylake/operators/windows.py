"""Choices by order: latest, first, sequences, most frequent, best matches. Every order ends in a total one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import joined


def total(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """The order made total by the text of the whole row, so that results do not depend on partitioning."""
    return [*order, joined([F.col(f"`{c}`") for c in sorted(df.columns)])]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, unique: bool = False) -> DataFrame:
    """The first n rows of each key. The rank limit is pushed before the shuffle, so a hot key sends n rows a task.

    Null keys are a group of their own; ties fall to the text of the row, which `unique` leaves out where the order has no
    ties within a key; an empty table stays empty.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order if unique else total(df, order))))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def sequence_with_neighbours(df: DataFrame, key: str, order: Sequence[str], state: str, day: str, unique: bool = False) -> DataFrame:
    """Rows numbered within the key, with the state before and after and the days spent in the one before."""
    by = [F.col(c) for c in order]
    w = Window.partitionBy(key).orderBy(*(by if unique else total(df, by)))
    return df.withColumns({"seq": F.row_number().over(w), "prev_state": F.lag(state).over(w), "next_state": F.lead(state).over(w), "days_in_prev": F.datediff(F.col(day), F.lag(day).over(w))})


def most_frequent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): the most frequent non-null value of each key, the least of equally frequent ones."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return first_by(counts, keys, [F.desc("n"), F.asc(value)], unique=True)


def repeat_within(df: DataFrame, scope: Sequence[str], start: str, end: str, unique: str, days: int = 30) -> DataFrame:
    """Adds gap_days to the row before in the scope (by start, then unique) and is_repeat for gaps from 0 to `days`.

    Rows with a null in the scope have no row before (gap null, is_repeat false). Scopes are entities such as persons;
    their number of rows is bounded by what happens to one of them.
    """
    whole = F.lit(True)
    for c in scope:
        whole = whole & F.col(c).isNotNull()
    gap = F.when(whole, F.datediff(start, F.lag(end).over(Window.partitionBy(*scope).orderBy(start, unique))))
    return df.withColumn("gap_days", gap).withColumn("is_repeat", F.coalesce(F.col("gap_days").between(0, days), F.lit(False)))


def resolve_unique(pairs: DataFrame, left: str, right: str, order: Sequence[Column], tie: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, doubtful) of scored candidate pairs, at most one for each left and each right key.

    A left key takes its best candidate unless the runner-up has equal `tie` columns (doubtful); of left keys that take the
    same right key the best stays and the others are doubtful. Repeated pairs count once. `reason` says why a row is doubtful.
    """
    rows = pairs.distinct()
    w = Window.partitionBy(left).orderBy(*order, F.asc(right))
    rows = rows.withColumn("__rank", F.row_number().over(w)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(left)))
    even = F.col("__n") > 1
    for c in tie:
        even = even & F.col(c).eqNullSafe(F.lead(c).over(w))
    best = rows.withColumn("__even", even).filter("__rank = 1")
    clear = best.filter("not __even").withColumn("__back", F.row_number().over(Window.partitionBy(right).orderBy(*order, F.asc(left))))
    drop = lambda df: df.drop("__rank", "__n", "__even", "__back")
    doubtful = drop(best.filter("__even")).withColumn("reason", F.lit("ambiguous")).unionByName(drop(clear.filter("__back > 1")).withColumn("reason", F.lit("contested")))
    return drop(clear.filter("__back = 1")), doubtful
