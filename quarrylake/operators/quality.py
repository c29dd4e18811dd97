"""Declared data checks: one pass over a table for all checks that need no other, and a gate."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPARE = {"gte": lambda v, t: v >= t, "lte": lambda v, t: v <= t, "eq": lambda v, t: abs(v - t) < 1e-9, "gt": lambda v, t: v > t, "lt": lambda v, t: v < t}


#: Measures of one's own by name: each takes a table and a check and gives a number.
MEASURES: dict[str, Callable[[DataFrame, Check], float]] = {}


def measure(name: str):
    """Registers a function as the measure of checks of that kind."""
    if name in KINDS or name in MEASURES:
        raise ValueError(f"there is a kind of check {name} already")

    def add(f: Callable[[DataFrame, Check], float]):
        MEASURES[name] = f
        return f

    return add


KINDS = ("row_count", "not_null", "unique", "range", "expression", "referential")


@dataclass(frozen=True)
class Check:
    """kind: one of KINDS or of MEASURES. A null threshold always passes."""

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    threshold: float | None = 1.0
    compare: str = "gte"
    blocking: bool = False
    low: float | None = None
    high: float | None = None
    predicate: str = ""
    target: tuple[str, str] = ("", "")
    extra: dict = field(default_factory=dict)


def _measure(c: Check):
    """Aggregate of a check as a share; an empty table has share 1."""
    n = F.count(F.lit(1))
    share = lambda bad: F.when(n == 0, 1.0).otherwise(1.0 - bad / n)
    if c.kind == "row_count":
        return n.cast("double")
    if c.kind == "not_null":
        return share(F.sum(F.when(F.col(c.columns[0]).isNull(), 1).otherwise(0)))
    if c.kind == "range":
        x = F.col(c.columns[0])
        out = F.lit(False)
        if c.low is not None:
            out = out | (x < c.low)
        if c.high is not None:
            out = out | (x > c.high)
        return share(F.sum(F.when(out, 1).otherwise(0)))
    if c.kind == "expression":
        return share(F.sum(F.when(F.expr(c.predicate), 0).otherwise(1)))
    raise ValueError(f"no such kind of check: {c.kind}")


def evaluate(spark: SparkSession, read: Callable[[str], DataFrame | None], checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, table, kind, value, threshold, passed, blocking. A missing table fails its checks.

    All checks of a table but unique and referential ones are a single aggregate. unique is the number of groups over that
    of rows, in two partial aggregates; referential is one minus orphans over non-null references, by an anti join.
    """
    by_table: dict[str, list[Check]] = defaultdict(list)
    for c in checks:
        by_table[c.table].append(c)
    values: dict[str, float | None] = {}
    for name, own in by_table.items():
        df = read(name)
        if df is None:
            values |= {c.name: None for c in own}
            continue
        plain = [c for c in own if c.kind not in ("unique", "referential", *MEASURES)]
        if plain:
            row = df.agg(*[_measure(c).alias(f"c{i}") for i, c in enumerate(plain)]).first()
            values |= {c.name: row[f"c{i}"] for i, c in enumerate(plain)}
        for c in own:
            if c.kind in MEASURES:
                values[c.name] = MEASURES[c.kind](df, c)
            if c.kind == "unique":
                row = df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")).first()
                values[c.name] = row["d"] / row["n"] if row["n"] else 1.0
            if c.kind == "referential":
                target = read(c.target[0])
                refs = df.filter(F.col(c.columns[0]).isNotNull()).select(F.col(c.columns[0]).alias("k"))
                if target is None:
                    values[c.name] = None
                    continue
                counts = refs.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
                keys = target.select(F.col(c.target[1]).alias("k")).dropna().distinct().withColumn("there", F.lit(1))
                row = counts.join(keys, "k", "left").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("there").isNull(), F.col("n")).otherwise(0)).alias("bad")).first()
                values[c.name] = 1.0 - row["bad"] / row["n"] if row["n"] else 1.0
    rows = []
    for c in checks:
        v = values[c.name]
        passed = v is not None and (c.threshold is None or COMPARE[c.compare](v, c.threshold))
        rows.append((c.name, c.table, c.kind, None if v is None else round(float(v), 6), None if c.threshold is None else float(c.threshold), passed, c.blocking))
    return spark.createDataFrame(rows, "check_name string, table_name string, kind string, value double, threshold double, passed boolean, blocking boolean")


def gate(results: DataFrame) -> None:
    """Error that names the blocking checks that failed, if any did."""
    failed = [r["check_name"] for r in results.filter("blocking and not passed").collect()]
    if failed:
        raise RuntimeError("blocking checks failed: " + ", ".join(sorted(failed)))


def stamped(results: DataFrame, run_id: str) -> DataFrame:
    """Results with the run and its time, for a history that is appended to."""
    return results.withColumns({"run_id": F.lit(run_id), "run_ts": F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp")})
