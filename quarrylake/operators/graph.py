"""Connected components by random contraction, finished in one task once few edges are left."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .lookup import HOT_SHARE, lookup

#: Edges that one task contracts by itself; more than these are first reduced by all tasks together.
ONE_TASK = 500_000


def _solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(at, next) of each node of the edges: a node of its component, by union and find."""
    up: dict = {}

    def root(v):
        while up.setdefault(v, v) != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for part in parts:
        for x, y in zip(part["x"], part["y"]):
            a, b = root(x), root(y)
            if a != b:
                up[max(a, b)] = min(a, b)
    yield pd.DataFrame({"at": list(up), "next": [root(v) for v in list(up)]})


def components(edges: DataFrame, a: str, b: str, rounds: int = 64, one_task: int = ONE_TASK) -> DataFrame:
    """(node, label): the least node of each connected component.

    While more than `one_task` edges are left, a round replaces every node by the first of itself and its neighbours in an
    order drawn anew by hash, and edges within a node vanish. Whatever the graph's shape, an expected constant share of the
    nodes goes in a round, so rounds follow the logarithm of the nodes and the work is that of the first few. A round is one
    checkpointed aggregate, which also tells the nodes with many edges, and one checkpointed pair of joins that splits those
    (see lookup). At most `one_task` edges, a fixed number however many there were, are then contracted in one task. The
    replacements are applied one after the other, and each component takes its least node; `one_task` changes no result.

    Edges with a null end are dropped; repeated and self edges do no harm; an empty table gives an empty one.
    """
    pairs = cut(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).dropna().distinct())
    kind = pairs.schema["x"].dataType
    labels = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("at", F.col("node"))
    left, moves = pairs.filter("x <> y"), []
    for r in range(rounds):
        n = left.count()
        if n <= one_task:
            break
        ends = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
        both = left.select(F.inline(ends))
        drawn = lambda c: F.struct(F.xxhash64(F.lit(r), c).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        first = cut(both.groupBy("x").agg(F.min(drawn("y")).alias("m"), F.count(F.lit(1)).alias("rows")).select("x", F.least("m", drawn("x"))["n"].alias("n"), "rows"))
        most = 2 * n * HOT_SHARE
        top = first.filter(F.col("rows") > most).select("x", "rows").collect()  # fewer than 1 / HOT_SHARE nodes
        hot = [(t["x"], t["rows"], -int(-t["rows"] // most)) for t in top]
        moves.append(first.select(F.col("x").alias("at"), F.col("n").alias("next")))
        half = lookup(left, first.select("x", F.col("n").alias("p")), ["x"], "inner", hot=hot)
        left = cut(lookup(half, first.select(F.col("x").alias("y"), F.col("n").alias("q")), ["y"], "inner", hot=hot).filter("p <> q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct())
    else:
        raise RuntimeError(f"edges are left after {rounds} rounds")
    if n:
        name = kind.simpleString()
        moves.append(cut(left.coalesce(1).mapInPandas(_solve, f"at {name}, next {name}")))
    for move in moves:
        labels = lookup(labels, move, ["at"]).select("node", F.coalesce("next", "at").alias("at"))
    labels = cut(labels)
    return lookup(labels, labels.groupBy("at").agg(F.min("node").alias("label")), ["at"]).select("node", "label")
