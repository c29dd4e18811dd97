from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylake.functions.dates import calendar, parse_by_source
from quarrylake.functions.similarity import jaro_winkler_of
from quarrylake.functions.text import normalize_name, normalize_phone, reference_sequence
from quarrylake.operators.entity import assign_stable_ids, block_pairs, exact_links, id_aliases, pair_quality
from quarrylake.operators.graph import components
from quarrylake.operators.inference import infer_codes
from quarrylake.operators.intervals import daily_state, expand_days, segments
from quarrylake.operators.joins import band_join, point_in_time, wildcard_match
from quarrylake.operators.quality import Check, evaluate, gate
from quarrylake.operators.references import orphans, reference_status
from quarrylake.operators.states import closure, move_class
from quarrylake.operators.windows import first_by, repeat_within, resolve_unique

D = date.fromisoformat


def one(spark, c, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(c(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, want", [("Dr. Mr. anita  RAO", "ANITA RAO"), ("o'brien-jones 3", "O BRIEN JONES"), ("Dravid", "DRAVID"), ("", ""), (None, None)])
def test_names(spark, raw, want):
    assert one(spark, normalize_name, raw) == want


@pytest.mark.parametrize("raw, want", [("+91 98765-43210", "9876543210"), ("098765 43210", "9876543210"), ("12345", None), (None, None)])
def test_phones(spark, raw, want):
    assert one(spark, normalize_phone, raw) == want


@pytest.mark.parametrize("raw, want", [("NH/2024/000123", 123), ("REF 7x", 7), ("none", None), (None, None), ("9" * 30, None)])
def test_reference_numbers(spark, raw, want):
    assert one(spark, reference_sequence, raw) == want


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=9), st.text("abcd", max_size=9))
def test_similarity_is_symmetric_and_bounded(a, b):
    s = jaro_winkler_of(a, b)
    assert 0 <= s <= 1 and abs(s - jaro_winkler_of(b, a)) < 1e-9
    assert (s == 1) == (a == b and a != "")


def test_dates_by_source_never_raise(spark):
    df = spark.createDataFrame([("a", "31/12/2024"), ("b", "12-31-2024"), ("c", "2024-12-31"), ("a", "31/02/2024"), ("a", None)], "s string, t string")
    got = df.select(parse_by_source(F.col("t"), F.col("s"), {"a": "dd/MM/yyyy", "b": "MM-dd-yyyy"})).collect()
    assert [r[0] for r in got] == [D("2024-12-31")] * 3 + [None, None]


def test_calendar_joins_holidays_of_one_day(spark):
    h = spark.createDataFrame([("2024-03-25", "B"), ("2024-03-25", "A")], "holiday_date string, holiday_name string")
    c = calendar(spark, "2024-03-24", "2024-04-01", holidays=h).orderBy("day").collect()
    assert len(c) == 9 and c[1]["holiday_name"] == "A / B" and not c[1]["is_working_day"]
    assert (c[7]["fiscal_year"], c[8]["fiscal_year"], c[8]["fiscal_quarter"], c[7]["fiscal_month"]) == ("FY2023-24", "FY2024-25", 1, 12)


def test_first_by_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 2, "z"), (None, 2, "z")], "k string, o int, v string")
    for n in (1, 3, 7):
        got = first_by(df.repartition(n), ["k"], [F.desc("o")]).collect()
        assert sorted((str(r["k"]), r["v"]) for r in got) == [("None", "z"), ("a", "x")]


def test_repeats_leave_out_null_scopes(spark):
    df = spark.createDataFrame([("p", "v1", D("2024-01-01"), D("2024-01-05")), ("p", "v2", D("2024-01-20"), D("2024-01-21")), ("p", "v3", D("2024-01-10"), D("2024-02-10")), (None, "v4", D("2024-01-01"), D("2024-01-02")), (None, "v5", D("2024-01-03"), D("2024-01-04"))], "p string, v string, a date, b date")
    got = {r["v"]: (r["gap_days"], r["is_repeat"]) for r in repeat_within(df, ["p"], "a", "b", "v").collect()}
    assert got == {"v1": (None, False), "v3": (5, True), "v2": (-21, False), "v4": (None, False), "v5": (None, False)}


def test_unique_resolution(spark):
    df = spark.createDataFrame([("c1", "b1", 0.9, 1), ("c1", "b2", 0.9, 1), ("c2", "b3", 0.9, 1), ("c2", "b4", 0.5, 1), ("c3", "b3", 0.8, 1), ("c4", "b5", 0.7, 1), ("c4", "b5", 0.7, 1)], "c string, b string, s double, d int")
    good, bad = resolve_unique(df, "c", "b", [F.desc("s")], ["s", "d"])
    assert sorted((r["c"], r["b"]) for r in good.collect()) == [("c2", "b3"), ("c4", "b5")]
    assert sorted((r["c"], r["reason"]) for r in bad.collect()) == [("c1", "ambiguous"), ("c3", "contested")]


def test_wildcards_prefer_by_priority_and_null_codes_match_stars(spark):
    facts = spark.createDataFrame([(1, "A", "X"), (2, "B", "X"), (3, None, "Y"), (4, "B", "Z")], "id int, c string, d string")
    rules = spark.createDataFrame([("r1", "A", "*", 1), ("r2", "*", "X", 2), ("r3", "*", "Y", 3)], "rule_id string, c string, d string, priority int")
    got = {r["id"]: r["rule_id"] for r in wildcard_match(facts, rules, ["c", "d"], "id", [F.asc_nulls_last("rule_priority")]).collect()}
    assert got == {1: "r1", 2: "r2", 3: "r3", 4: None}


def test_band_join_equals_brute_force(spark):
    a = [(i, "k" if i % 3 else None, D(f"2024-01-{1 + i % 28:02d}"), float(i)) for i in range(40)]
    x = spark.createDataFrame(a, "i int, k string, d1 date, t1 double")
    y = spark.createDataFrame(a, "j int, k string, d2 date, t2 double")
    got = {(r["i"], r["j"]) for r in band_join(x, y, ["k"], {("d1", "d2"): 3}, {("t1", "t2"): 0.3}).collect()}
    assert got == {(p[0], q[0]) for p in a for q in a if p[1] and q[1] and abs((p[2] - q[2]).days) <= 3 and abs(p[3] - q[3]) <= 0.3 * abs(q[3])}


def test_point_in_time_keeps_facts_and_their_columns(spark):
    v = spark.createDataFrame([("a", D("2024-01-01"), D("2024-05-31"), "x"), ("a", D("2024-06-01"), D("9999-12-31"), "y")], "k string, valid_from date, valid_to date, dept string")
    f = spark.createDataFrame([(1, "a", D("2024-03-01"), "own"), (2, "a", D("2023-03-01"), "own"), (3, None, D("2024-03-01"), "own")], "id int, k string, day date, valid_to string")
    got = sorted((r["id"], r["valid_to"], r["dept"]) for r in point_in_time(f, v, "k", "day", ["dept"]).collect())
    assert got == [(1, "own", "x"), (2, "own", None), (3, "own", None)]


def test_segments_and_days(spark):
    ts = lambda s: datetime.fromisoformat(s)
    ev = spark.createDataFrame([(1, "v1", ts("2024-03-01T10:00"), "IN", "p"), (2, "v1", ts("2024-03-04T09:00"), "OUT", "p"), (3, "v2", ts("2024-03-02T10:00"), "IN", "q"), (4, "v3", ts("2022-03-02T10:00"), "IN", "r"), (5, None, ts("2022-03-02T10:00"), "IN", "r")], "e int, v string, t timestamp, kind string, who string")
    s = segments(ev, "v", "t", "e", "kind", ["IN"], "2024-03-31").withColumn("place", F.lit("w"))
    got = {r["v"]: (str(r["start_date"]), str(r["end_date"]), r["is_open"]) for r in s.collect()}
    assert got == {"v1": ("2024-03-01", "2024-03-04", False), "v2": ("2024-03-02", "2024-03-31", True), "v3": ("2022-03-02", "2022-04-16", True)}
    assert expand_days(s.filter("v = 'v1'"), "start_date", "end_date").count() == 4
    day = {str(r["day"]): r for r in daily_state(s, "place", "who").collect()}
    assert (day["2024-03-02"]["present"], day["2024-03-04"]["ends"], day["2024-03-04"]["mean_days"], day["2024-03-01"]["mean_days"]) == (2, 1, 4.0, None)


def test_moves(spark):
    moves = {"a": ["b"], "b": ["c"], "c": []}
    assert closure(moves) == {"a": {"b", "c"}, "b": {"c"}, "c": set()}
    df = spark.createDataFrame([(None, "a"), ("a", "b"), ("a", "c"), ("c", "a"), ("zz", "a")], "p string, s string")
    assert [r[0] for r in df.select(move_class(F.col("p"), F.col("s"), moves)).collect()] == ["INITIAL", "DIRECT", "GAP", "ILLEGAL", "ILLEGAL"]


def test_components(spark):
    e = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 100), (7, 7), (None, 1), (200, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(e, "a int, b int"), "a", "b").collect()}
    assert got == {i: 0 for i in range(21)} | {100: 100, 101: 100, 200: 200}
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_stable_ids_when_clusters_merge(spark):
    c1 = spark.createDataFrame([("r2", "r2"), ("r3", "r3")], "node string, label string")
    first = {r["node"]: r["entity_id"] for r in assign_stable_ids(c1, None).collect()}
    assert sorted(first.values()) == [1, 2]
    reg = spark.createDataFrame(list(first.items()), "node string, entity_id bigint")
    c2 = spark.createDataFrame([("r1", "r1"), ("r2", "r1"), ("r3", "r1"), ("r9", "r9")], "node string, label string")
    second = {r["node"]: r["entity_id"] for r in assign_stable_ids(c2, reg).collect()}
    assert second == {"r1": 1, "r2": 1, "r3": 1, "r9": 3}


def test_pairs_links_and_quality(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "a"), (3, "x", "b"), (4, None, "b"), (4, None, "b")], "r int, p string, q string")
    got = {(r["a"], r["b"]): r["strategies"] for r in block_pairs(df, "r", {"p": F.col("p"), "q": F.col("q")}, most=10).collect()}
    assert got == {(1, 2): ["p", "q"], (1, 3): ["p"], (2, 3): ["p"], (3, 4): ["q"]}
    assert block_pairs(df, "r", {"p": F.col("p")}, most=2).count() == 0
    assert sorted(tuple(r) for r in exact_links(df, "r", "p").collect()) == [(1, 2), (1, 3)]
    r = pair_quality(df.filter("p is not null"), "r", "p", "q").first()
    assert (r["n_predicted"], r["n_actual"], r["n_both"], r["precision"], r["recall"], r["f1"]) == (3, 1, 1, 0.333333, 1.0, 0.5)


def test_code_tiers(spark):
    cat = spark.createDataFrame([("knee repair", "ortho", "K1"), ("heart bypass", "cardio", "H1"), ("heart bypasz", "cardio", "H2"), ("hip repair", "ortho", "A1"), ("hip repair ii", "ortho", "A1")], "name string, grp string, code string")
    items = spark.createDataFrame([(1, "x", "ortho", "OWN"), (2, "knee repair", "ortho", None), (3, "knee repaif", "ortho", None), (4, "heart bypasx", "cardio", None), (5, None, "ortho", None), (6, None, None, None), (7, "", "zz", None)], "id int, name string, grp string, code string")
    got = {r["id"]: (r["tier"], r["inferred_code"]) for r in infer_codes(items, cat, "id", "name", "grp", "code").collect()}
    assert got == {1: ("SOURCE", "OWN"), 2: ("EXACT_NAME", "K1"), 3: ("FUZZY_NAME", "K1"), 4: ("GROUP", "H1"), 5: ("GROUP", "A1"), 6: ("UNMAPPED", None), 7: ("UNMAPPED", None)}


def test_orphans(spark):
    t = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    r = spark.createDataFrame([(1, "a", "r1"), (1, "z", "r2"), (None, "a", "r3"), (None, "z", "r4"), (None, None, "r5"), (2, None, "r6")], "x int, y string, id string")
    ids = lambda m: sorted(q["id"] for q in orphans(r, t, ["x", "y"], match=m).collect())
    assert (ids("simple"), ids("partial"), ids("full")) == (["r2"], ["r2", "r4"], ["r2", "r3", "r4", "r6"])
    assert orphans(r, t.limit(0), ["x", "y"]).count() == 2
    with pytest.raises(ValueError):
        orphans(r, t, ["x"], match="other")
    seen = t.withColumn("first_seen", F.lit(5))
    got = reference_status(r.withColumn("at", F.lit(3)), seen, "x", "x", {"f": F.min("first_seen")}, [("late", F.col("f") > F.col("at"))])
    assert sorted((q["id"], q["orphan_kind"]) for q in got.collect()) == [("r1", "late"), ("r2", "late"), ("r6", "late")]


def test_checks_and_gate(spark):
    t = spark.createDataFrame([(1, None), (2, 5), (2, 50)], "k int, v int")
    read = lambda n: t if n == "t" else None
    checks = [Check("rows", "t", "row_count", threshold=1), Check("key", "t", "unique", ("k",), blocking=True), Check("v", "t", "not_null", ("v",), threshold=None), Check("r", "t", "range", ("v",), high=10), Check("e", "t", "expression", predicate="v < 10"), Check("gone", "u", "row_count"), Check("ref", "t", "referential", ("k",), target=("t", "v"))]
    got = evaluate(spark, read, checks)
    assert {r["check_name"]: (r["value"], r["passed"]) for r in got.collect()} == {"rows": (3.0, True), "key": (0.666667, False), "v": (0.666667, True), "r": (0.666667, False), "e": (0.333333, False), "gone": (None, False), "ref": (0.0, False)}
    with pytest.raises(RuntimeError, match="key"):
        gate(got)
    empty = evaluate(spark, lambda n: t.limit(0), [Check("key", "t", "unique", ("k",)), Check("v", "t", "not_null", ("v",))])
    assert all(r["passed"] for r in empty.collect())


def test_pairs_of_blocks_of_any_size(spark):
    n = 300
    df = spark.range(n).select("id", F.lit("hot").alias("p"), (F.col("id") % 100).cast("string").alias("q")).unionByName(spark.createDataFrame([(None, "hot", "1"), (n, "alone", None)], "id bigint, p string, q string"))
    keys = {"p": F.col("p"), "q": F.col("q")}
    want = {(a, b): ["p", "q"] if (b - a) % 100 == 0 else ["p"] for a in range(n) for b in range(a + 1, n)}
    for part in (1000, 7):
        rows = block_pairs(df, "id", keys, part).collect()
        assert len(rows) == len(want) and {(r["a"], r["b"]): r["strategies"] for r in rows} == want
    small = df.filter("id < 5")
    assert sorted(map(str, block_pairs(small, "id", keys).collect())) == sorted(map(str, block_pairs(small, "id", keys, 2, most=5).collect()))
    assert block_pairs(df.limit(0), "id", keys).count() == 0


def test_missing_references_by_anti_join(spark):
    r = spark.createDataFrame([(1, 5), (2, 6), (3, None), (4, 7), (4, 7)], "id int, x int").withColumn("at", F.lit(3))
    t = spark.createDataFrame([(5, 1), (5, 9), (6, 8), (None, 0)], "x int, seen int")
    got = reference_status(r, t, "x", "x", {"f": F.min("seen")}, [("late", F.col("f") > F.col("at")), ("never", F.lit(None).cast("boolean"))])
    assert sorted((q["id"], q["orphan_kind"]) for q in got.collect()) == [(2, "late"), (4, "missing"), (4, "missing")]
    assert "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()


def test_soundex_blocks_equal_brute_force(spark, tmp_path):
    rows = [("1", "Robert Miller", "1980-01-02", "Pune"), ("2", "Rupert Muller", "1980-05-06", "Delhi"), ("3", "Rupert Meller", None, "pune "), ("4", "Robert", "1980-01-02", None), ("5", "Anna Miller", "1980-01-02", "Pune"), ("6", None, "1980-01-02", "Pune"), ("7", "Robert", None, "Pune")]
    spark.createDataFrame(rows, "mpi_id string, name string, dob string, city string").withColumn("dob", F.col("dob").cast("date")).write.parquet(str(tmp_path / "patient_master.parquet"))
    sound = {"robert": "R163", "rupert": "R163", "anna": "A500", "miller": "M460", "muller": "M460", "meller": "M460"}

    def keys(name, dob, city):
        w = [sound[x] for x in (name or "").lower().split()]
        first, last = (w or [None])[0], w[-1] if len(w) > 1 else None
        parts = {"date": (first, dob), "year": (first, last, dob and dob[:4]), "city": (first, last, city and city.strip().lower())}
        return {(k, *v) for k, v in parts.items() if all(v)}

    want = {}
    for x in rows:
        for y in rows:
            if x[0] < y[0] and (shared := keys(*x[1:]) & keys(*y[1:])):
                want[x[0], y[0]] = ",".join(sorted(k[0] for k in shared))
    from quarrylake.plans.star import soundex_blocks

    assert len(want) == 3 and {(r["a"], r["b"]): r["strategies"] for r in soundex_blocks(spark, str(tmp_path)).collect()} == want
