"""Joins of a large table with a table of one row per key, safe against hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: A key is hot above this share of the rows, so that there are fewer than 1 / HOT_SHARE hot keys at any size.
HOT_SHARE = 1 / 256


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[tuple]:
    """(key..., rows, pieces) of every key with more than `share` of the rows: at most 1 / share of them.

    Counts are pre-aggregated in the map tasks; only the largest 1 / share counts reach the driver. `pieces` is into how
    many parts a key must be split for each part to be within the share. Null keys are left out; an empty table has none.
    """
    seen = Observation()
    some = df.select(*on).dropna(subset=list(on)).observe(seen, F.count(F.lit(1)).alias("n"))
    top = some.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).orderBy(F.desc("__rows")).limit(math.ceil(1 / share)).collect()
    if not top:
        return []
    most = seen.get["n"] * share
    return [(*r, math.ceil(r["__rows"] / most)) for r in top if r["__rows"] > most and r["__rows"] > 1]


def lookup(facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", share: float = HOT_SHARE, hot: list[tuple] | None = None) -> DataFrame:
    """facts joined with `table`, which has one row for a key, where any key may hold a third of the facts.

    Rows of a hot key are spread over as many parts as needed, and only the table's rows of hot keys are repeated, once a
    part: at most 2 / share more rows. Other keys are joined as they are. Null keys match nothing (left keeps the facts).
    Columns besides `on` must have different names on the two sides. `how` is left, inner, left_semi or left_anti. `hot` are
    the hot keys if the caller knows them, as hot_keys gives them.
    """
    hot = hot_keys(facts, on, share) if hot is None else hot
    if not hot:
        return facts.join(table, list(on), how)
    spark = facts.sparkSession
    schema = ", ".join([f"`{c}` {facts.schema[c].dataType.simpleString()}" for c in on] + ["__pieces int"])
    pieces = F.broadcast(spark.createDataFrame([(*r[: len(on)], r[-1]) for r in hot], schema))  # fewer than 1 / share rows
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.coalesce("__pieces", F.lit(1)))
    left = facts.join(pieces, list(on), "left").withColumn("__salt", salt.cast("int")).drop("__pieces")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))
    right = table.join(pieces, list(on), "left").withColumn("__salt", every).drop("__pieces")
    return left.join(right, [*on, "__salt"], how).drop("__salt")
