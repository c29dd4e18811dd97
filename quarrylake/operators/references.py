"""References to records that do not exist, were deleted or came later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import hot_keys, lookup


def null_mask(columns: Sequence[Column]) -> Column:
    """Which of the columns are not null, as a number: the first column is the lowest bit."""
    return sum((F.when(c.isNotNull(), 2**i).otherwise(0) for i, c in enumerate(columns)), F.lit(0)).cast("int")


def orphans(refs: DataFrame, targets: DataFrame, columns: Sequence[str], target_columns: Sequence[str] | None = None, match: str = "simple", hot: list[tuple] | None = None) -> DataFrame:
    """Rows of refs whose composite reference has no target.

    References are grouped by null mask and those of each mask are anti-joined on its non-null columns: the mask is a number
    beside the columns, each target is there once for every mask that the match looks at with the other columns taken out,
    and all masks share one shuffle, in which hot references are split (see lookup). match, as in SQL: `simple`, a
    reference with any null is no orphan; `partial`, the non-null columns must agree with some target, all null is no
    orphan; `full`, all null is no orphan and a part of nulls always is. Repeated references stay. Empty targets: every
    reference that the match considers is an orphan. Extra columns of refs are kept, those of targets are not read. `hot` are
    the hot whole references if the caller knows them, as hot_keys gives them.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"match is simple, partial or full, not {match}")
    target_columns = list(target_columns or columns)
    whole = 2 ** len(columns) - 1
    masks = list(range(1, whole + 1)) if match == "partial" else [whole]
    mask = null_mask([F.col(f"`{c}`") for c in columns])
    # structs compare field by field and take null for equal to null; the mask says which fields count
    here = F.struct(F.col("__mask").alias("m"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = refs.withColumn("__mask", mask)
    asked = rows.filter(F.col("__mask").isin(masks)).withColumn("__ref_key", here)
    there = [F.struct(F.lit(m).alias("m"), *[F.when(F.lit(bool(m >> i & 1)), F.col(f"`{t}`")).cast(refs.schema[c].dataType).alias(f"c{i}") for i, (c, t) in enumerate(zip(columns, target_columns))]) for m in masks]
    keys = targets.select(F.explode(F.array(*there)).alias("__ref_key"))
    struct_keys = None if hot is None else [((whole, *h[: len(columns)]), *h[len(columns) :]) for h in hot]
    filled = null_mask([F.col(f"__ref_key.c{i}") for i in range(len(columns))]) == F.col("__ref_key.m")
    found = lookup(asked, keys.filter(filled).distinct(), ["__ref_key"], "left_anti", hot=struct_keys).drop("__ref_key")
    if match == "full":
        found = found.unionByName(rows.filter((F.col("__mask") > 0) & (F.col("__mask") < whole)))
    return found.drop("__mask")


def reference_status(refs: DataFrame, targets: DataFrame, column: str, target_column: str, facts: dict[str, Column], kinds: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows of refs with a non-null reference that is not in order, and why, as orphan_kind.

    targets is aggregated to one row per key with `facts` (name -> aggregate), so it can be any size and repeat keys; a
    reference without one is `missing`, otherwise the first of `kinds` (name, condition over refs and facts) that is true
    counts, and references for which none is are left out. The missing ones come from orphans() with a simple match; only the
    kinds are joined, and keys with many references are split there (see lookup). A null condition is not true.
    """
    refs = refs.withColumn("__ref", F.col(column))
    hot = hot_keys(refs, ["__ref"])
    missing = orphans(refs, targets, ["__ref"], [target_column], "simple", hot).withColumn("orphan_kind", F.lit("missing"))
    known = targets.filter(F.col(target_column).isNotNull()).groupBy(F.col(target_column).alias("__ref")).agg(*[v.alias(k) for k, v in facts.items()])
    kind = F.lit(None).cast("string")
    for name, cond in reversed(kinds):
        kind = F.when(cond, name).otherwise(kind)
    found = lookup(refs.filter(F.col("__ref").isNotNull()), known, ["__ref"], "inner", hot=hot).withColumn("orphan_kind", kind).filter(F.col("orphan_kind").isNotNull())
    return found.drop("__ref", *facts).unionByName(missing.drop("__ref"))
