"""Groups of records from pairwise matches: hash-to-min over relations."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.lookup import HOT_SHARE, lookup
from ..session import drop_written, shared_folder, written


def _kept(df: DataFrame) -> tuple[DataFrame, tuple]:
    """df written to the shared folder, and a digest of its rows that does not depend on their order."""
    seen = Observation()
    path = os.path.join(shared_folder(df.sparkSession), f"groups-{uuid.uuid4().hex}")
    low = F.xxhash64("v", "u")
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(low.cast("decimal(20,0)")).alias("s"), F.bit_xor(low).alias("x")).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out, (seen.get["n"], seen.get["s"], seen.get["x"])


def hash_to_min(pairs: DataFrame, a: str, b: str, most_rounds: int = 64) -> DataFrame:
    """(node, group): for every node of the pairs the least node that is reached from it, directly or indirectly.

    Each node v has a cluster, kept as rows (v, u) and never as one value. In a round v finds its least member m, sends its
    cluster to m and m to every member, until no cluster changes: a chain of n links is halved a round. Least members are
    partial aggregates, and clusters that hold much of the table are split over many tasks (lookup). Each round is a table
    in the shared folder, so a lost executor costs a part of one round; the table of the round before is then deleted.

    Pairs with a null side are dropped, pairs of a node with itself make a group of one, repeated pairs count once, an empty
    table gives an empty one. Order is that of the ids' own type (strings by their bytes).
    """
    some = pairs.select(F.col(a).alias("v"), F.col(b).alias("u")).dropna()
    both = F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x, y in ("vu", "uv", "vv", "uu")])
    rows, digest = _kept(some.select(F.inline(both)).distinct())
    for _ in range(most_rounds):
        # one aggregate gives least members and, by their counts, the clusters to split
        least = written(rows.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        most = digest[0] * HOT_SHARE
        top = least.filter((F.col("n") > most) & (F.col("n") > 1)).select("v", "n").collect()  # fewer than 1 / HOT_SHARE
        hot = [(t["v"], t["n"], math.ceil(t["n"] / most)) for t in top]
        sent = F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))
        before = rows
        rows, new = _kept(lookup(rows, least.drop("n"), ["v"], "inner", hot=hot).select(F.inline(sent)).distinct())
        drop_written(before, least)
        if new == digest:
            return rows.groupBy("v").agg(F.min("u").alias("group")).withColumnRenamed("v", "node")
        digest = new
    raise RuntimeError(f"clusters still change after {most_rounds} rounds")


def groups_by_shared(members: DataFrame, member: str, shared: str) -> DataFrame:
    """(member, group_id): one row per non-null member, where two that have a non-null `shared` value in common are linked.

    Each shared value links its members to the least of them, as many links as it has members. A member without any shared
    value is a group of its own.
    """
    ties = members.select(F.col(member).alias("__m"), F.col(shared).alias("__s"))
    every = ties.select("__m").dropna().distinct()
    ties = ties.dropna().distinct()
    first = ties.groupBy("__s").agg(F.min("__m").alias("__first"))
    links = lookup(ties, first, ["__s"], "inner").filter("__m <> __first").select("__m", "__first").distinct()
    found = hash_to_min(links, "__m", "__first").select(F.col("node").alias("__m"), "group")
    return every.join(found, "__m", "left").select(F.col("__m").alias(member), F.coalesce("group", "__m").alias("group_id"))
