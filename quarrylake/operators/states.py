"""State machines: closure of allowed moves and classes of observed ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def closure(moves: Mapping[str, Sequence[str]]) -> dict[str, set[str]]:
    """States that can be reached from each in one or more moves."""
    reach = {s: set(to) for s, to in moves.items()}
    while True:
        wider = {s: to.union(*[reach.get(t, set()) for t in to]) for s, to in reach.items()}
        if wider == reach:
            return reach
        reach = wider


def move_class(before: Column, after: Column, moves: Mapping[str, Sequence[str]]) -> Column:
    """INITIAL without a state before, DIRECT for an allowed move, GAP if it can be reached over unseen states, else ILLEGAL."""
    one_of = lambda table: F.coalesce(F.create_map(*[x for s, to in table.items() for x in (F.lit(s), F.array(*[F.lit(t) for t in sorted(to)]).cast("array<string>"))])[before], F.array().cast("array<string>"))
    return F.when(before.isNull(), "INITIAL").when(F.array_contains(one_of(moves), after), "DIRECT").when(F.array_contains(one_of(closure(moves)), after), "GAP").otherwise("ILLEGAL")
