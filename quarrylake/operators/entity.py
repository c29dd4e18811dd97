"""Entity resolution: blocking, pair scores, exact links, stable ids, surviving records, precision and recall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import lookup
from .windows import first_by


def block_keys(df: DataFrame, record: str, strategies: Mapping[str, Column]) -> DataFrame:
    """(record, strategy, block_key) for every strategy's non-null key, in one pass."""
    return df.select(record, F.explode(F.array(*[F.struct(F.lit(n).alias("strategy"), c.cast("string").alias("block_key")) for n, c in strategies.items()])).alias("s")).select(record, "s.*").filter("block_key is not null")


def block_sizes(keys: DataFrame) -> DataFrame:
    """(strategy, block_key, n): how large each block is."""
    return keys.groupBy("strategy", "block_key").agg(F.count(F.lit(1)).alias("n"))


def block_pairs(df: DataFrame, record: str, strategies: Mapping[str, Column], part: int = 64, most: int | None = None) -> DataFrame:
    """(a, b, strategies), a < b: all pairs that share a block of any size, each once, with all its strategies.

    A block of n records is split by hash into n / part parts, and each two parts (and each part with itself) meet in a cell
    of their own, so that a hot block's pairs are made in many tasks; `part` changes no result. The pairs are as many as the
    blocks define: they grow with the square of a block, so records alike in all that is compared should stand in it once
    (see pipeline.people.classes). `most`, by default off, leaves the pairs of blocks of more records out: the caller then
    reports these by oversized(). Null records are in no pair.
    """
    keys = block_keys(df.filter(F.col(record).isNotNull()), record, strategies).distinct()
    parts = block_sizes(keys).filter(F.col("n").between(2, most) if most else F.col("n") > 1).select("strategy", "block_key", F.ceil(F.col("n") / part).cast("int").alias("__parts"))
    keys = keys.join(parts, ["strategy", "block_key"]).withColumn("__part", F.pmod(F.xxhash64(record), F.col("__parts")).cast("int"))
    cell = ["strategy", "block_key", "__i", "__j"]
    x = keys.select("strategy", "block_key", F.col(record).alias("__x"), F.col("__part").alias("__i"), F.explode(F.sequence("__part", F.col("__parts") - 1)).alias("__j"))
    y = keys.select("strategy", "block_key", F.col(record).alias("__y"), F.explode(F.sequence(F.lit(0), "__part")).alias("__i"), F.col("__part").alias("__j"))
    both = x.join(y, cell).filter("__i < __j or __x < __y")
    return both.groupBy(F.least("__x", "__y").alias("a"), F.greatest("__x", "__y").alias("b")).agg(F.sort_array(F.collect_set("strategy")).alias("strategies"))


def oversized(df: DataFrame, record: str, strategies: Mapping[str, Column], most: int) -> DataFrame:
    """Blocks of every strategy with more than `most` records, with their sizes: keys that tell little. Nothing is left out
    for it: block_pairs makes the pairs of blocks of any size."""
    return block_sizes(block_keys(df, record, strategies).distinct()).filter(F.col("n") > most)


def weighted_score(parts: Mapping[str, Column], weights: Mapping[str, float], digits: int = 4) -> Column:
    """Weighted mean of the components that are not null; null if all are."""
    up = down = F.lit(0.0)
    for name, c in parts.items():
        up = up + F.when(c.isNotNull(), c * F.lit(weights[name])).otherwise(0.0)
        down = down + F.when(c.isNotNull(), F.lit(weights[name])).otherwise(0.0)
    return F.round(up / F.nullif(down, F.lit(0.0)), digits)


def exact_links(df: DataFrame, record: str, key: str) -> DataFrame:
    """(a, b): each record of a non-null key linked to the least one, so links are as many as records; hot keys are split."""
    rows = df.select(F.col(record).alias("b"), F.col(key).alias("__k")).dropna().distinct()
    return lookup(rows, rows.groupBy("__k").agg(F.min("b").alias("a")), ["__k"], "inner").filter("a < b").select("a", "b")


def three_way(score: Column, accept: float, review: float) -> Column:
    """'match', 'review' or 'none'."""
    return F.when(score >= accept, "match").when(score >= review, "review").otherwise("none")


def assign_stable_ids(clusters: DataFrame, registry: DataFrame | None, record: str = "node", label: str = "label", parts: int = 64) -> DataFrame:
    """(record, label, entity_id): ids that stay when clusters grow or merge.

    registry: (record, entity_id) of earlier runs, or None. A cluster takes the least id of its members in the registry; if a
    cluster was split, the part with the least label keeps the id and the others are new. New clusters are numbered after the
    greatest id, by label: counted and numbered within hash parts side by side, with each part's offset from the counts, so
    that no single task sees all of them. What id_aliases tells was given up should be kept.
    """
    spark = clusters.sparkSession
    kind = clusters.schema[record].dataType.simpleString()
    known = (registry if registry is not None else spark.createDataFrame([], f"`{record}` {kind}, entity_id bigint")).select(F.col(record), F.col("entity_id").alias("__old"))
    held = clusters.join(known, record).groupBy(label).agg(F.min("__old").alias("__old"))
    old = held.groupBy("__old").agg(F.min(label).alias(label))
    new = clusters.select(label).distinct().join(old, label, "left_anti").withColumn("__part", F.pmod(F.xxhash64(label), F.lit(parts)))
    top = known.agg(F.coalesce(F.max("__old"), F.lit(0)).alias("top")).first()["top"]
    counts = {r["__part"]: r["count"] for r in new.groupBy("__part").count().collect()}  # at most `parts` rows
    before, total = {}, top
    for p in range(parts):
        before[p] = total
        total += counts.get(p, 0)
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__part").cast("int"))
    new = new.select(label, (offset + F.row_number().over(Window.partitionBy("__part").orderBy(label))).cast("bigint").alias("__new"))
    ids = old.select(label, F.col("__old").alias("entity_id")).unionByName(new.select(label, F.col("__new").alias("entity_id")))
    return lookup(clusters.select(record, label), ids, [label], "inner").select(record, label, "entity_id")


def id_aliases(ids: DataFrame, registry: DataFrame, record: str = "node") -> DataFrame:
    """(old_id, entity_id): ids of the registry that records no longer have, with the ids that these have now."""
    old = registry.select(record, F.col("entity_id").alias("old_id"))
    return ids.select(record, "entity_id").join(old, record).filter("old_id <> entity_id").select("old_id", "entity_id").distinct()


def survivors(df: DataFrame, entity: str, order: Sequence[Column], sources: str) -> DataFrame:
    """The first row of each entity by order, with n_records, n_sources and the sorted set of its sources."""
    about = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_records"), F.sort_array(F.collect_set(sources)).alias("source_set"))
    return first_by(df, [entity], order).join(about.withColumn("n_sources", F.size("source_set")), entity)


def pair_quality(df: DataFrame, record: str, predicted: str, actual: str) -> DataFrame:
    """One row: pairs predicted, actual and both, precision, recall and f1, from group sizes only (no pairs are made)."""
    rows = df.select(record, predicted, actual).distinct()
    pairs = lambda *by: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)).alias("x"))
    p, a, b = (pairs(*by).select(F.col("x").alias(n)) for n, by in (("n_predicted", [predicted]), ("n_actual", [actual]), ("n_both", [predicted, actual])))
    one = p.unionByName(a, True).unionByName(b, True).agg(*[F.max(n).alias(n) for n in ("n_predicted", "n_actual", "n_both")])  # one row each
    pr, rc = F.col("n_both") / F.nullif(F.col("n_predicted"), F.lit(0.0)), F.col("n_both") / F.nullif(F.col("n_actual"), F.lit(0.0))
    return one.withColumns({"precision": F.round(pr, 6), "recall": F.round(rc, 6), "f1": F.round(2 * pr * rc / F.nullif(pr + rc, F.lit(0.0)), 6)})
