"""How much of what is true was recovered: rows of (check_name, value, detail), for the scorecard beside declared checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _share(up, down):
    return F.coalesce(F.round(up / F.nullif(down, F.lit(0)), 6), F.lit(0.0))


def recovery(found: DataFrame, truth: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """<name>_coverage (share of the true rows found) and <name>_fidelity (share of the found rows that are true), over
    different rows, null equal to null: one shuffle of both sides, no join."""
    key = F.struct(*[F.col(c) for c in on]).alias("k")
    both = found.select(key, F.lit(1).alias("f"), F.lit(0).alias("t")).unionByName(truth.select(key, F.lit(0).alias("f"), F.lit(1).alias("t")))
    one = both.groupBy("k").agg(F.max("f").alias("f"), F.max("t").alias("t")).agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f"), F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum(F.col("f") * F.col("t")), F.lit(0)).alias("b"))
    told = lambda what, c: F.struct(F.lit(f"{name}_{what}").alias("check_name"), _share(F.col("b"), F.col(c)).alias("value"), F.concat(F.col("b").cast("string"), F.lit(" of "), F.col(c).cast("string")).alias("detail"))
    return one.select(F.inline(F.array(told("coverage", "t"), told("fidelity", "f"))))


def lifecycle_health(lifecycle: DataFrame) -> DataFrame:
    """Share of the claims that reached a final state, and the number of moves that can't be."""
    one = lifecycle.groupBy("claim_id").agg(F.max(F.col("is_terminal").cast("int")).alias("t"), F.sum((F.col("transition_class") == "ILLEGAL").cast("int")).alias("i"))
    one = one.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("i"), F.lit(0)).alias("i"))
    row = lambda name, v, d: F.struct(F.lit(name).alias("check_name"), v.cast("double").alias("value"), d.alias("detail"))
    reached = F.concat(F.col("t").cast("string"), F.lit(" of "), F.col("n").cast("string"))
    return one.select(F.inline(F.array(row("terminal_state_rate", _share(F.col("t"), F.col("n")), reached), row("illegal_transitions", F.col("i"), F.col("i").cast("string")))))


def code_fill(rows: DataFrame, tier: str = "icd10_source", code: str = "icd10_code") -> DataFrame:
    """Share of rows with a code, and the share of each tier."""
    by = rows.groupBy(F.coalesce(tier, F.lit("UNMAPPED")).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.count(code).alias("c"))
    every = by.agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.collect_list(F.struct("tier", F.col("n").alias("m"))).alias("tiers"))  # a handful of tiers
    text = lambda up: F.concat(up.cast("string"), F.lit(" of "), F.col("n").cast("string"))
    row = lambda name, up: F.struct(name.alias("check_name"), _share(up, F.col("n")).alias("value"), text(up).alias("detail"))
    return every.filter("n > 0").select(F.inline(F.concat(F.array(row(F.lit("code_fill"), F.col("c"))), F.transform("tiers", lambda t: row(F.concat(F.lit("code_"), F.lower(t["tier"])), t["m"])))))


def link_health(accepted: DataFrame, review: DataFrame, claims: DataFrame) -> DataFrame:
    """Share of the claims that were linked, of the links that are corroborated, and of the claims that wait for review."""
    n = claims.select("claim_id").dropna().distinct().agg(F.count(F.lit(1)).alias("n"))
    a = accepted.agg(F.count(F.lit(1)).alias("a"), F.coalesce(F.sum(F.col("is_corroborated").cast("int")), F.lit(0)).alias("c"))
    r = review.agg(F.count(F.lit(1)).alias("r"))
    # one row each, put side by side by an aggregate
    one = n.unionByName(a, True).unionByName(r, True).agg(*[F.max(x).alias(x) for x in "nacr"])
    text = lambda up, down: F.concat(F.col(up).cast("string"), F.lit(" of "), F.col(down).cast("string"))
    row = lambda name, up, down: F.struct(F.lit(name).alias("check_name"), _share(F.col(up), F.col(down)).alias("value"), text(up, down).alias("detail"))
    return one.select(F.inline(F.array(row("link_rate", "a", "n"), row("corroboration_rate", "c", "a"), row("review_rate", "r", "n"))))
