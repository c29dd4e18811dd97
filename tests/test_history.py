import random
from datetime import date, datetime

from pyspark.sql import functions as F

from quarrylake.functions.text import row_hash, same_text
from quarrylake.operators.history import as_of, close_open, snapshot_changes, standing, type2_loads, type2_merge
from quarrylake.operators.lookup import hot_keys, lookup

D = date.fromisoformat
ROWS = "k string, start date, until date, dept string, loaded timestamp, version int"


def rows(spark, data):
    return spark.createDataFrame([(k, D(a), D(b) if b else None, d, datetime(2024, 1, t), 7) for k, a, b, d, t in data], ROWS)


def merge(df, current=None):
    got = type2_merge(current, df, "k", "start", "until", {"dept": same_text(F.col("dept"))}, ["loaded"])
    return got


def told(history):
    return sorted((r["k"], str(r["valid_from"]), str(r["valid_to"]), r["version"], r["is_current"]) for r in history.versions.collect())


def test_same_rows_make_one_version_and_style_is_no_change(spark):
    df = rows(spark, [("a", "2024-01-01", None, "ENT", 1), ("a", "2024-02-01", None, " ent ", 2), ("a", "2024-03-01", None, "Ent", 3)] * 2)
    assert told(merge(df)) == [("a", "2024-01-01", "9999-12-31", 1, True)]


def test_back_and_forth_gaps_and_corrections(spark):
    df = rows(spark, [("a", "2024-01-01", None, "x", 1), ("a", "2024-03-01", None, "y", 1), ("a", "2024-03-01", None, "z", 2), ("a", "2024-05-01", "2024-05-10", "x", 1), ("a", "2024-06-01", None, "x", 1)])
    assert told(merge(df)) == [
        ("a", "2024-01-01", "2024-02-29", 1, False),
        ("a", "2024-03-01", "2024-04-30", 2, False),
        ("a", "2024-05-01", "2024-05-10", 3, False),
        ("a", "2024-06-01", "9999-12-31", 4, True),
    ]


def test_null_is_a_value_and_null_keys_are_left_out(spark):
    df = rows(spark, [("a", "2024-01-01", None, None, 1), ("a", "2024-02-01", None, None, 1), ("a", "2024-03-01", None, "", 1), (None, "2024-01-01", None, "x", 1)])
    assert [x[:3] for x in told(merge(df))] == [("a", "2024-01-01", "2024-02-29"), ("a", "2024-03-01", "9999-12-31")]


def test_merge_in_two_loads_equals_one(spark):
    one = rows(spark, [("a", "2024-01-01", None, "x", 1), ("b", "2024-01-01", None, "x", 1)])
    two = rows(spark, [("a", "2024-02-01", None, "x", 1), ("a", "2024-03-01", None, "y", 1), ("c", "2024-02-01", None, "q", 1)])
    assert told(merge(two, merge(one))) == told(merge(one.union(two)))
    assert told(merge(two.limit(0), merge(one))) == told(merge(one))
    assert told(merge(one.limit(0))) == []


def test_late_loads_in_any_order_equal_all_at_once(spark):
    rng = random.Random(5)
    for _ in range(4):
        every = [(rng.choice("ab"), f"2024-{rng.randint(1, 6):02d}-{rng.choice((1, 15)):02d}", rng.choice([None, None, "2024-05-20"]), rng.choice("xy"), t) for t in range(1, 13)]
        want = told(merge(rows(spark, every)))
        rng.shuffle(every)
        one = merge(rows(spark, every[:4])).stored()
        two = merge(rows(spark, every[4:8]), one).stored()
        assert told(merge(rows(spark, every[8:]), two)) == want
        three = type2_loads(rows(spark, every), F.pmod(F.dayofmonth("loaded"), F.lit(4)), "k", "start", "until", {"dept": same_text(F.col("dept"))}, ["loaded"])
        assert told(three) == want


def test_merge_keeps_untouched_keys_and_carries_attributes(spark):
    one = merge(rows(spark, [("a", "2024-01-01", None, " X ", 1), ("b", "2024-01-01", None, "y", 1)]))
    two = merge(rows(spark, [("b", "2024-01-01", None, "Y", 2)]), one)
    assert told(two) == told(one) and len({r["sk"] for r in two.versions.collect()}) == 2
    assert sorted(r["dept"] for r in two.versions.collect()) == ["x", "y"]
    closed = close_open(two.versions, F.lit("2024-06-30").cast("date")).collect()
    assert {str(r["valid_to"]) for r in closed} == {"2024-06-30"} and not any(r["is_current"] for r in closed)


def test_as_of_never_sees_what_became_known_later(spark):
    changes = spark.createDataFrame([("a", D("2024-01-01"), None, "x", D("2024-01-01")), ("a", D("2024-02-01"), None, "y", D("2024-03-10")), ("a", D("2024-01-15"), None, "w", D("2024-04-01"))], "k string, start date, until date, dept string, told date")
    events = spark.createDataFrame([(i, "a", D(d)) for i, d in enumerate(("2024-02-15", "2024-03-10", "2024-04-02"))], "id int, k string, day date")
    got = as_of(events, changes, "k", "day", "start", "until", ["dept"], known="told")
    assert sorted((r["id"], r["dept"]) for r in got.collect()) == [(0, "x"), (1, "y"), (2, "y")]


def test_standing_takes_the_latest_and_breaks_ties_alike(spark):
    df = rows(spark, [("a", "2024-01-01", None, "x", 1), ("a", "2024-01-01", None, "y", 1), ("a", "2024-01-01", None, "w", 0 + 1)])
    for n in (1, 3, 7):
        assert [r["dept"] for r in standing(df.repartition(n), ["k", "start"], ["loaded"], ["dept"]).collect()] == ["y"]


def test_as_of_uses_only_what_holds(spark):
    changes = spark.createDataFrame([("a", D("2024-01-01"), D("2024-01-31"), "x"), ("a", D("2024-03-01"), None, "y"), (None, D("2024-01-01"), None, "z")], "k string, start date, until date, dept string")
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01", "2024-03-01", "2030-01-01"]
    events = spark.createDataFrame([(i, "a", D(d), "other") for i, d in enumerate(days)] * 2 + [(9, None, D("2024-01-01"), ""), (10, "b", None, "")], "id int, k string, day date, start string")
    got = as_of(events, changes, "k", "day", "start", "until", ["dept"])
    assert sorted((r["id"], r["dept"]) for r in got.collect()) == sorted([(1, "x"), (2, "x"), (4, "y"), (5, "y")] * 2)
    assert as_of(events.limit(0), changes, "k", "day", "start", "until", ["dept"]).count() == 0
    assert as_of(events, changes.limit(0), "k", "day", "start", "until", ["dept"]).count() == 0


def changes_of(spark, data):
    df = spark.createDataFrame([(k, D(s), v) for k, s, v in data], "k string, s date, v string")
    got = snapshot_changes(df, "k", "s", "v")
    return sorted((r["k"], str(r["from_snapshot"]), str(r["to_snapshot"]), r["change_kind"]) for r in got.collect())


def test_snapshot_changes_over_a_gap(spark):
    a, b, c, d = "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"
    got = changes_of(spark, [("p", a, "1"), ("p", b, "1"), ("p", d, "1"), ("q", a, "1"), ("q", b, "2"), ("q", c, None), ("q", d, None), ("r", d, "1"), (None, a, "1")])
    assert got == [("p", b, c, "removed"), ("p", c, d, "added"), ("q", a, b, "changed"), ("q", b, c, "changed"), ("r", c, d, "added")]
    assert changes_of(spark, [("p", a, "1")]) == []


def test_snapshot_that_lost_all_its_keys_counts(spark):
    df = spark.createDataFrame([("p", D("2024-01-01"), "1"), ("p", D("2024-03-01"), "1")], "k string, s date, v string")
    dates = spark.createDataFrame([(D(x),) for x in ("2024-01-01", "2024-02-01", "2024-03-01")], "s date")
    assert sorted(r["change_kind"] for r in snapshot_changes(df, "k", "s", "v", dates).collect()) == ["added", "removed"]


def test_lookup_splits_hot_keys_and_keeps_all_rows(spark):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 900).cast("string"))).alias("k"), "id")
    keys = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, v int")
    hot = hot_keys(facts, ["k"])
    assert [(h[0], h[1]) for h in hot] == [("hot", 10_000)] and hot[0][2] > 50
    got, want = lookup(facts, keys, ["k"]), facts.join(keys, "k", "left")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == 30_000
    assert lookup(facts.limit(0), keys, ["k"]).count() == 0
    assert lookup(facts, keys, ["k"], "inner").count() == facts.join(keys, "k").count()


def test_row_hash_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a|", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), ("~null~", "a"), ("", "-"), ("-", ""), ("1:a", "b"), ("1", ":ab")], "x string, y string")
    assert df.select(row_hash([F.col("x"), F.col("y")])).distinct().count() == 11
