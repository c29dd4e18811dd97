"""Histories: standing rows, type-two merge, attributes as of an event, changes between snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import joined, row_hash, surrogate_key
from ..session import drop_written, written
from .lookup import lookup

OPEN = "9999-12-31"


def standing(df: DataFrame, keys: Sequence[str], newest: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest `newest` (nulls lowest), as a partial aggregate: a key with a third of
    all rows shrinks to one row a map task before the shuffle. Ties fall to the greatest text of the kept columns, so the
    result does not depend on the order of rows. Rows with a null key are dropped; an empty table gives an empty one.
    """
    order = F.struct(*[F.col(c) for c in newest], joined([F.col(c) for c in keep]))
    rows = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max_by(F.struct(*keep), order).alias("__row"))
    return rows.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in keep])


def periods(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """rows (one per key and start) with `end` made the last day each holds: its own end (null: open) or the day before the
    key's next row begins, whichever is earlier. Rows that hold for no day are dropped after they have cut the one before.

    A key's rows are at most one a day, so a window over a key is bounded by the calendar and not by the table.
    """
    own = F.coalesce(F.col(end), F.lit(OPEN).cast("date"))
    after = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    return rows.withColumn(end, F.least(own, F.date_sub(after, 1))).filter(F.col(end) >= F.col(start))


@dataclass(frozen=True)
class History:
    """A type-two dimension: `versions`, and the standing `rows` they follow from, which a later merge needs.

    versions: key, valid_from, valid_to, version, hash_diff, is_current, sk (of key and valid_from) and the attributes.
    rows: key, from, to (as delivered), hash_diff, the order that makes a row stand, and the attributes.
    """

    rows: DataFrame
    versions: DataFrame

    def stored(self, name: str = "history") -> History:
        """Both tables written to the shared folder, so that the next merge compares with what is stored."""
        return History(written(self.rows, f"{name}-rows"), written(self.versions, f"{name}-versions"))

    def drop(self) -> None:
        drop_written(self.rows, self.versions)


def _versions_of(rows: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Versions of standing rows: series of adjacent rows with equal hash, with the attributes of the first row of each."""
    held = periods(rows, key, "__from", "__to")
    w = Window.partitionBy(key).orderBy("__from")
    goes_on = (F.lag("hash_diff").over(w) == F.col("hash_diff")) & (F.date_add(F.lag("__to").over(w), 1) == F.col("__from"))
    held = held.withColumn("__new", F.when(goes_on, 0).otherwise(1)).withColumn("version", F.sum("__new").over(w).cast("int"))
    out = held.groupBy(key, "version").agg(F.min("__from").alias("valid_from"), F.max("__to").alias("valid_to"), F.min_by(F.struct("hash_diff", *[f"`{c}`" for c in names]), "__from").alias("__row"))
    current = (F.col("valid_to") == F.lit(OPEN).cast("date")).alias("is_current")
    return out.select(key, "valid_from", "valid_to", "version", F.col("__row.hash_diff").alias("hash_diff"), current, surrogate_key([F.col(key), F.col("valid_from")]).alias("sk"), *[F.col(f"__row.{c}").alias(c) for c in names])


def type2_merge(current: History | None, updates: DataFrame, key: str, start: str, end: str, attributes: dict[str, Column], newest: Sequence[str] = ()) -> History:
    """Type-two merge of a load into a history (None: the first load), whatever the loads' order.

    updates: rows with key, start, end and whatever `attributes` (name -> Column, compared by hash) are built from. Of rows
    with equal key and start the one with the greatest `newest` stands, be it stored or in the load. Only keys for which a
    row that now stands is new or differs from the stored one (attribute hash or end) are merged: their changed versions are
    closed the day before the next begins, and new ones are opened; a row that is adjacent and has the hash of the version
    before extends it. All other keys keep their versions as they are. As the standing rows are kept, late loads and
    corrections of the past give what all loads at once would.

    Null key or start: dropped. Null end: open. Null attribute: a value of its own. Repeated rows: as one. Empty load: as before.
    Attributes must not be named as the key, `hash_diff`, `version`, `valid_from`, `valid_to`, `is_current` or `sk`.
    """
    names, order = list(attributes), [f"__n{i}" for i in range(len(newest))]
    values = list(attributes.values())
    rows = updates.select(F.col(key), F.col(start).cast("date").alias("__from"), F.col(end).cast("date").alias("__to"), row_hash(values).alias("hash_diff"), *[v.alias(n) for n, v in attributes.items()], *[F.col(c).alias(n) for n, c in zip(order, newest)])
    keep = ["__to", "hash_diff", *names, *order]
    new = standing(rows, [key, "__from"], order, keep)
    if current is None:
        return History(new, _versions_of(new, key, names))
    loaded = new.select(key).distinct()
    both = current.rows.join(loaded, key, "left_semi").withColumn("__old", F.lit(True)).unionByName(new.withColumn("__old", F.lit(False)))
    wins = F.struct(*order, joined([F.col(c) for c in keep]))
    was = F.max(F.when(F.col("__old"), F.struct("hash_diff", F.coalesce("__to", F.lit(OPEN).cast("date")).alias("to"))))
    stood = both.groupBy(key, "__from").agg(F.max_by(F.struct(*keep), wins).alias("__row"), was.alias("__was"))
    now = F.struct(F.col("__row.hash_diff"), F.coalesce("__row.__to", F.lit(OPEN).cast("date")).alias("to"))
    stood = stood.select(key, "__from", *[F.col(f"__row.{c}").alias(c) for c in keep], (~F.col("__was").eqNullSafe(now)).alias("__differs"))
    stood = written(stood, "standing")  # read three times below
    touched = stood.filter("__differs").select(key).distinct()
    stood = stood.drop("__differs")
    kept = current.versions.join(touched, key, "left_anti")
    again = _versions_of(stood.join(touched, key, "left_semi"), key, names)
    return History(current.rows.join(loaded, key, "left_anti").unionByName(stood), kept.unionByName(again))


def type2_loads(updates: DataFrame, load: Column, key: str, start: str, end: str, attributes: dict[str, Column], newest: Sequence[str] = ()) -> History:
    """Loads merged one after the other in order of `load` (a Column of few values, such as the year of arrival; null first),
    each into the stored history of those before it; tables of earlier loads are deleted."""
    marked = updates.withColumn("__load", load)
    loads = sorted((r["__load"] for r in marked.select("__load").distinct().collect()), key=lambda v: (v is not None, v))
    out = None
    for n, v in enumerate(loads):
        before = out
        part = marked.filter(F.col("__load").eqNullSafe(F.lit(v)))
        out = type2_merge(before, part, key, start, end, attributes, newest)
        if n + 1 < len(loads):
            if before is None:  # versions follow from the rows as they are stored
                rows = written(out.rows, "history-rows")
                out = History(rows, written(_versions_of(rows, key, list(attributes)), "history-versions"))
            else:
                out = out.stored()
                before.drop()
    return out if out is not None else type2_merge(None, updates, key, start, end, attributes, newest)


def close_open(versions: DataFrame, day: Column, end: str = "valid_to") -> DataFrame:
    """versions with open ones ended on the day and no longer current; those that begin after it stay as they are."""
    open_ = (F.col(end) == F.lit(OPEN).cast("date")) & (F.col("valid_from") <= day)
    return versions.withColumns({end: F.when(open_, day).otherwise(F.col(end)), "is_current": F.col("is_current") & ~open_})


def as_of(events: DataFrame, changes: DataFrame, key: str, event_date: str, start: str, end: str, carry: Sequence[str], how: str = "inner", known: str | None = None) -> DataFrame:
    """events with the columns `carry` of the change that holds on each event's day (inner: events without one are left out,
    left: they have nulls).

    Events and changes are united, sorted by key and the day a change became available, changes before events of the same
    day, and the last change is carried forward. It is available from its start on or, if `known` names the column of the day
    on which it became known, from then if that is later: an event never sees what was learned after it. Only the different
    (key, day) pairs of the events go through that window, at most one a day and key, so a key with a third of all events does
    not make one large task; they are joined back with hot pairs split.

    changes: one row per key and start; of the available ones the latest start counts. Null key or day: no match. Repeated
    events stay. `carry` must not name columns of events.
    """
    days = events.select(F.col(key).alias("__k"), F.col(event_date).alias("__day")).dropna().distinct()
    ready = F.col(start) if known is None else F.greatest(F.col(start), F.col(known).cast("date"))
    known_row = F.struct(F.col(start).alias("__start"), F.col(end).alias("__end"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)])
    ready_rows = changes.select(F.col(key).alias("__k"), ready.alias("__day"), F.col(start).alias("__from"), known_row.alias("__known")).dropna(subset=["__k", "__day", "__from"])
    both = ready_rows.withColumn("__is_event", F.lit(0)).unionByName(days.withColumn("__is_event", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy("__k").orderBy("__day", "__is_event").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("__known", ignorenulls=True) if known is None else F.max_by("__known", "__from")
    seen = both.withColumn("__known", last.over(w)).filter("__is_event = 1")
    seen = seen.filter(F.col("__known").isNotNull() & F.coalesce(F.col("__known.__end") >= F.col("__day"), F.lit(True)))
    seen = seen.select("__k", "__day", *[F.col(f"__known.__c{i}").alias(c) for i, c in enumerate(carry)])
    left = events.withColumns({"__k": F.col(key), "__day": F.col(event_date)})
    return lookup(left, seen, ["__k", "__day"], how).drop("__k", "__day")


def snapshot_changes(states: DataFrame, key: str, snapshot: str, state: str, dates: DataFrame | None = None) -> DataFrame:
    """What was added, removed or changed from each snapshot to the next: (key, from_snapshot, to_snapshot, change_kind).

    states: one row per key and snapshot with the state's hash. `dates` are the snapshots that count as consecutive, by
    default those in states. Rows are numbered by snapshot; series of consecutive snapshots with equal state are the
    islands, and where one begins or ends tells the change: begin right after another island's end is `changed`, begin after
    a gap (not at the first snapshot) is `added`, end before a gap (not at the last) is `removed`. A key has at most one row
    a snapshot, so windows are bounded by the number of snapshots. Null key or snapshot: dropped. One snapshot: no change.
    """
    every = (states if dates is None else dates).select(F.col(snapshot).alias("__snap")).dropna().distinct()
    # one row a snapshot, bounded by the days of the calendar: position, date and the next one's date
    one = Window.orderBy("__snap")
    line = every.select((F.row_number().over(one) - 1).alias("__at"), "__snap", F.lead("__snap").over(one).alias("__next"))
    rows = states.select(F.col(key).alias("__k"), F.col(snapshot).alias("__snap"), F.col(state).alias("__state")).dropna(subset=["__k", "__snap"])
    rows = rows.join(F.broadcast(line.drop("__next")), "__snap")
    w = Window.partitionBy("__k").orderBy("__at")
    goes_on = F.lag("__state").over(w).eqNullSafe(F.col("__state")) & (F.lag("__at").over(w) == F.col("__at") - 1)
    begins = F.when(goes_on, 0).otherwise(1)
    islands = rows.withColumn("__i", F.sum(begins).over(w)).groupBy("__k", "__i").agg(F.min("__at").alias("__b"), F.max("__at").alias("__e"))
    v = Window.partitionBy("__k").orderBy("__i")
    islands = islands.withColumns({"__pe": F.lag("__e").over(v), "__nb": F.lead("__b").over(v)})
    adjacent = F.coalesce(F.col("__pe") == F.col("__b") - 1, F.lit(False))
    start = F.struct((F.col("__b") - 1).alias("__at"), F.when(adjacent, "changed").otherwise("added").alias("change_kind"))
    gap = ~F.coalesce(F.col("__nb") == F.col("__e") + 1, F.lit(False))
    stop = F.when(gap, F.struct(F.col("__e").alias("__at"), F.lit("removed").alias("change_kind")))
    events = islands.select("__k", F.explode(F.array_compact(F.array(start, stop))).alias("x")).select("__k", "x.*")
    # no snapshot stands before the first and none follows the last, so begins of the first and ends of the last find no partner
    told = events.join(F.broadcast(line.filter("__next is not null")), "__at")
    return told.select(F.col("__k").alias(key), F.col("__snap").alias("from_snapshot"), F.col("__next").alias("to_snapshot"), "change_kind")
