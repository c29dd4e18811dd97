"""Joins by containment, wildcard and tolerance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .history import as_of
from .lookup import lookup


def point_in_time(facts: DataFrame, versions: DataFrame, key: str, day: str, carry: Sequence[str], start: str = "valid_from", end: str = "valid_to", how: str = "left") -> DataFrame:
    """facts with `carry` of the version whose closed period holds the day. Versions of a key must not overlap.

    left keeps facts without such a version with nulls; repeated facts stay. Keys and pairs of key and day with many facts are
    split (see as_of). Facts may have columns named as in `carry` only if they are not wanted: the versions' come out.
    """
    kept = [c for c in facts.columns if c not in carry]
    return as_of(facts.select(*[F.col(f"`{c}`") for c in kept]), versions, key, day, start, end, carry, how)


def wildcard_match(facts: DataFrame, rules: DataFrame, on: Sequence[str], key: str, order: Sequence[Column], day: str | None = None, wild: str = "*", how: str = "left") -> DataFrame:
    """Each fact with the best rule: every `on` column is equal or the wildcard, the day (if given) lies from effective_from
    to effective_to, and `order` over the rule's columns decides (then rule_id). Rule columns get the prefix rule_.

    The facts' distinct combinations of `on` and day are met with the rules by equality: each combination is repeated once
    for every choice of wildcards (2 ** columns), so no condition over all pairs is left. The best rule is picked among a
    combination's rules, and only then joined back to the facts, hot combinations split (see lookup): no fact goes through a
    window. Null codes match wildcards only; `key` is not read and stands for the fact's own.
    """
    rules = rules.select(*[F.col(c).alias(c if c.startswith("rule_") else f"rule_{c}") for c in rules.columns])
    by = [*on, *([day] if day else [])]
    # combinations are one struct, in which null is equal to null
    combo = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(by)])
    combos = facts.select(combo.alias("__combo")).distinct()
    field = lambda i: F.col(f"__combo.c{i}")
    choices = [F.struct(*[(F.lit(wild) if w >> i & 1 else field(i).cast("string")).alias(f"w{i}") for i in range(len(on))]) for w in range(2 ** len(on))]
    asked = combos.select("__combo", F.explode(F.array_distinct(F.array(*choices))).alias("w")).select("__combo", "w.*")
    fits = asked.join(rules, [F.col(f"w{i}") == F.col(f"rule_{c}").cast("string") for i, c in enumerate(on)]).drop(*[f"w{i}" for i in range(len(on))])
    if day:
        fits = fits.filter(field(len(on)).between(F.col("rule_effective_from"), F.col("rule_effective_to")))
    rank = F.row_number().over(Window.partitionBy("__combo").orderBy(*order, F.col("rule_rule_id" if "rule_rule_id" in rules.columns else "rule_id").asc_nulls_last()))
    best = fits.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
    return lookup(facts.withColumn("__combo", combo), best, ["__combo"], how).drop("__combo")


def band_join(left: DataFrame, right: DataFrame, on: Sequence[str], bands: Mapping[tuple[str, str], float], ratio: Mapping[tuple[str, str], float] | None = None) -> DataFrame:
    """Pairs with equal `on` columns, whose columns differ by at most each band (dates: days) and each ratio of the right one.

    The first band is also a cell number: the right side is repeated for the neighbouring cells, so that rows of a frequent
    key meet only within the tolerance. Column names of the two sides must differ but for `on`. Nulls match nothing.
    """
    (a, b), width = next(iter(bands.items()))
    number = lambda df, c: F.unix_date(F.col(c)) if df.schema[c].dataType.typeName() == "date" else F.col(c).cast("double")
    cell = lambda x: F.floor(x / F.lit(max(float(width), 1e-9) + (1 if width == 0 else 0))).cast("bigint")
    l = left.withColumn("__cell", cell(number(left, a)))
    r = right.withColumn("__cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: cell(number(right, b)) + i)))
    out = l.join(r, [*on, "__cell"]).drop("__cell")
    for (x, y), w in bands.items():
        out = out.filter(F.abs(number(left, x) - number(right, y)) <= w)
    for (x, y), w in (ratio or {}).items():
        out = out.filter(F.abs(F.col(x) - F.col(y)) <= F.lit(w) * F.abs(F.col(y)))
    return out
