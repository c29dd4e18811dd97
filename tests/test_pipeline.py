import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.entity import assign_stable_ids, id_aliases
from quarrylake.operators.inference import _share_a_piece
from quarrylake.operators.quality import MEASURES, Check, evaluate, measure
from quarrylake.pipeline import claims, config, gold, links, measures, people, procedures, rules, stays
from quarrylake.pipeline.run import SCORECARD, main, parser
from quarrylake.sources.ingest import summary
from quarrylake.sources.store import TableStore

D = date.fromisoformat
RAW = "hospital_id string, patient_id string, name string, dob string, phone string, city string, gender string, updated timestamp, extra string"


def regs(spark, *rows):
    return people.registrations(spark.createDataFrame([(h, p, n, d, f, c, g, datetime(2024, 1, t), "x") for h, p, n, d, f, c, g, t in rows], RAW), {"H2": "dd/MM/yyyy"})


def test_registrations_keep_the_latest_and_never_raise(spark):
    got = {r["patient_id"]: r for r in regs(spark, ("H1", "a", "Dr. Asha  Rao", "1980-02-01", "+91 98765 43210", " pune", "female", 1), ("H1", "a", "Asha Rao", "1980-02-01", "98765 43210", "Pune", "F", 2), ("H2", "b", "Rao", "31/12/1980", "1", "", None, 1), ("H2", "c", None, "1980-99-99", None, None, None, 1), (None, "d", "x", None, None, None, None, 1)).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"]["full_name"] == "ASHA RAO" and (got["a"]["first_name"], got["a"]["last_name"], got["a"]["phone_last4"], got["a"]["gender"]) == ("ASHA", "RAO", "3210", "F")
    assert got["b"]["dob"] == D("1980-12-31") and got["b"]["last_name"] is None and got["b"]["exact_key"] is None and got["b"]["city"] is None
    assert got["c"]["dob_parse_failed"] and not got["b"]["dob_parse_failed"] and got["a"]["exact_key"]


def test_people_keep_their_ids_as_registrations_come(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one = [("H1", "a", "Asha Rao", "1980-02-01", "9876543210", "Pune", "F", 1), ("H2", "b", "Vikram Nair", "01/03/1975", "9876500000", "Kochi", "M", 1), ("H1", "c", "Asha Rao", "1980-02-01", "9876543210", "Pune", "F", 1)]
    people.resolve(store, regs(spark, *one))
    ids = lambda: {(r["hospital_id"], r["patient_id"]): r["mpi_id"] for r in store.read(people.CROSSWALK).collect()}
    first = ids()
    assert first["H1", "a"] == first["H1", "c"] != first["H2", "b"] and all(v.startswith("MPI0000") and len(v) == 12 for v in first.values())
    two = [*one, ("H3", "d", "Asha Rao", "1980-02-01", "9876543210", "Pune", "F", 5), ("H3", "e", "Zoya Khan", None, None, None, None, 1)]
    people.resolve(store, regs(spark, *two))
    second = ids()
    assert {k: second[k] for k in first} == first and second["H3", "d"] == first["H1", "a"] and second["H3", "e"] not in first.values()
    m = {r["mpi_id"]: r for r in store.read(people.MASTER).collect()}[first["H1", "a"]]
    assert (m["source_record_count"], m["source_hospital_count"], m["hospitals"]) == (3, 2, ["H1", "H3"])
    assert store.row_count(people.ALIASES) == 0
    people.resolve(store, regs(spark, *two))
    assert ids() == second


def test_aliases_tell_ids_given_up_and_split_clusters_share_none(spark):
    reg = spark.createDataFrame([("r1", 1), ("r2", 2), ("r5", 5), ("r6", 5)], "node string, entity_id bigint")
    c = spark.createDataFrame([("r1", "r1"), ("r2", "r1"), ("r5", "r5"), ("r6", "r6")], "node string, label string")
    ids = assign_stable_ids(c, reg)
    assert {r["node"]: r["entity_id"] for r in ids.collect()} == {"r1": 1, "r2": 1, "r5": 5, "r6": 6}
    assert sorted(tuple(r) for r in id_aliases(ids, reg).collect()) == [(2, 1), (5, 6)]


def test_scores_of_typing_slips(spark):
    r = regs(spark, ("H1", "a", "Asha Rao", "1980-02-01", "9876543210", "Pune", "F", 1), ("H1", "b", "Asha Rao", "1980-01-02", "9876543201", None, "M", 1), ("H1", "c", "Asha Roa", "1980-02-02", None, "Pune", "M", 1))
    ids = {x["patient_id"]: x["record_id"] for x in r.collect()}
    pair = lambda x, y: tuple(sorted((ids[x], ids[y])))
    got = {(s["a"], s["b"]): s for s in people.score(spark.createDataFrame([pair("a", "b"), pair("a", "c")], "a string, b string"), r).collect()}
    ab, ac = got[pair("a", "b")], got[pair("a", "c")]
    assert (ab["dob_sim"], ab["phone_sim"], ab["city_sim"], ab["gender_conflict"]) == (0.75, 0.85, None, True) and ab["match_score"] == round((0.4 + 0.225 + 0.17) / 0.9, 4)
    assert (ac["dob_sim"], ac["phone_sim"], ac["city_sim"]) == (0.75, None, 1.0) and ac["match_score"] > 0.8  # its name is near enough not to be halved


def test_late_exports_renumber_their_claims_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    row = lambda c, s, d, e: (c, s, d, e, "p", "h", "i", "10.5", None, d, None)
    schema = "claim_id string, final_status string, status_date string, export_date string, patient_id string, hospital_id string, insurer_id string, claim_amount string, approved_amount string, submitted_date string, rejection_reason string"
    take = lambda *rows: claims.take(store, claims.normalized(spark.createDataFrame(list(rows), schema)))
    told = lambda: {(r["claim_id"], r["status_code"]): (r["transition_seq"], r["transition_class"], r["days_in_prev_status"]) for r in store.read(claims.LIFECYCLE).collect()}
    take(row("c1", "Submitted", "2024-01-01", "2024-01-07"), row("c1", " APPROVED", "2024-01-20", "2024-01-21"), row("c2", "settled", "2024-02-01", "bad"), row(None, "x", None, None), row("c3", "  ", None, None))
    assert told() == {("c1", "Submitted"): (1, "INITIAL", None), ("c1", "Approved"): (2, "GAP", 19), ("c2", "Settled"): (1, "INITIAL", None)}
    take(row("c1", "Under  Review", "2024-01-10", "2024-01-14"), row("c1", "approved", "2024-01-20", "2024-01-28"))
    assert told()["c1", "Approved"] == (3, "DIRECT", 10) and told()["c1", "Under Review"] == (2, "DIRECT", 9) and store.row_count(claims.LIFECYCLE) == 4
    before = store.row_count(claims.AUDIT)
    take(row("c1", "Under Review", "2024-01-10", "2024-02-14"))
    assert store.row_count(claims.AUDIT) == before and told()["c1", "Approved"] == (3, "DIRECT", 10)
    assert {r["claim_id"]: r["status_code"] for r in claims.latest_state(store.read(claims.LIFECYCLE)).collect()} == {"c1": "Approved", "c2": "Settled"}


def test_ward_days(spark):
    s = spark.createDataFrame([("w", "p", D("2024-01-01"), D("2024-01-02"), False), ("w", "p", D("2024-01-02"), D("2024-01-03"), True), ("w", None, D("2024-01-02"), D("2024-01-02"), False)], "ward string, who string, start_date date, end_date date, is_open boolean")
    beds = spark.createDataFrame([("w", 1)], "ward string, bed_count int")
    got = {str(r["day"]): r for r in stays.ward_days(s, beds, ["ward"], "who").collect()}
    two = got["2024-01-02"]
    assert (two["occupied_beds"], two["open_stays"], two["admissions"], two["discharges"], two["mean_stay"], two["occupancy_rate"], two["is_over_capacity"]) == (1, 1, 1, 1, 1.5, 1.0, False)
    assert stays.capacities(None, s.withColumn("bed", F.lit("b")), ["ward"], "bed").first()["bed_count"] == 1
    with pytest.raises(ValueError):
        stays.capacities(None, s, ["ward"])


def test_links_by_two_routes(spark):
    c = spark.createDataFrame([("c1", "H", "NH/2024/007", D("2024-01-01"), 100.0), ("c2", "H", None, D("2024-01-01"), 100.0), ("c3", "H", "9", D("2024-05-01"), None), (None, "H", "9", None, 1.0)], "claim_id string, hospital_id string, hospital_ref_no string, admission_date date, claim_amount double")
    b = spark.createDataFrame([("NH-2024-000007", "H", D("2024-01-02"), 100.0), ("NH-2024-000008", "H", D("2024-01-02"), 101.0), ("NH-2024-000009", "H", D("2023-01-02"), 5.0)], "bill_id string, hospital_id string, admission_date date, net_payable double")
    got = links.link(c, b)
    rows = {r["claim_id"]: (r["bill_id"][-1], r["match_method"], r["match_confidence"], r["is_corroborated"]) for r in got.accepted.collect()}
    assert rows["c1"] == ("7", "REFERENCE", 0.99, True) and rows["c3"] == ("9", "REFERENCE", 0.98, False)
    assert {(r["claim_id"], r["reason"]) for r in got.review.collect()} == {("c2", "contested")}
    told = {r["check_name"]: r["value"] for r in measures.link_health(got.accepted, got.review, c).collect()}
    assert told == {"link_rate": round(2 / 3, 6), "corroboration_rate": 0.5, "review_rate": round(1 / 3, 6)}
    assert links.link(c.limit(0), b).accepted.count() == 0


def test_rules_and_defaults(spark):
    r = spark.createDataFrame([("r1", "i", "*", 0.1, 1, D("2024-01-01"), D("2024-06-30")), ("r2", "i", "*", 0.2, 1, D("2024-07-01"), D("9999-12-31"))], "rule_id string, insurer_id string, kind string, pct double, priority int, effective_from date, effective_to date")
    f = spark.createDataFrame([(1, "i", "a", D("2024-06-30")), (2, "i", None, D("2024-07-01")), (3, "j", "a", D("2024-07-01")), (4, "i", "a", None)], "id int, insurer_id string, kind string, day date")
    got = {x["id"]: (x["rule_id"], x["rule_pct"]) for x in rules.resolve_rules(f, r, ["insurer_id", "kind"], "day", ["pct"]).collect()}
    assert got == {1: ("r1", 0.1), 2: ("r2", 0.2), 3: (None, 0.0), 4: (None, 0.0)}
    assert [x["pct"] for x in rules.lookup_or(f, r.limit(1), ["insurer_id"], {"pct": F.lit(0.0)}).orderBy("id").collect()] == [0.1, 0.1, 0.0, 0.1]


def test_seeds_skip_comments(spark, tmp_path):
    (tmp_path / "h.csv").write_text("# a note\nholiday_date,holiday_name,holiday_type\n2024-01-26,Republic Day,N\n")
    assert rules.load_seeds(spark, {"holidays": str(tmp_path / "h.csv")})["holidays"].collect()[0]["holiday_date"] == D("2024-01-26")


def test_pieces_lose_no_near_name(spark):
    import random

    rng = random.Random(1)
    words = ["".join(rng.choice("ab c") for _ in range(rng.randint(1, 24))) for _ in range(150)]
    near = [w[:i] + rng.choice(["", "z", "zz"]) + w[i + rng.randint(0, 2):] for w in words for i in [rng.randint(0, len(w))]]
    n = spark.createDataFrame([(w,) for w in set(near)], "__n string")
    e = spark.createDataFrame([(w, "c") for w in set(words)], "__cn string, __cc string")
    fits = F.levenshtein("__n", "__cn") / F.greatest(F.length("__n"), F.length("__cn")) <= 0.15
    got = {tuple(r) for r in _share_a_piece(n, e, 0.15).filter(fits).collect()}
    want = {tuple(r) for r in n.crossJoin(e).filter(fits).collect()}
    assert got == want and want


def test_procedures(spark):
    p = spark.createDataFrame([("P1", " Knee Repair - Left", "ortho", None, 1, "a"), ("P1", "Old", "ortho", "X", 0, "a"), ("P2", "Graft (Revision)", "skin", " ", 1, "a"), (None, "x", None, None, 1, "a")], "procedure_code string, procedure_name string, specialty string, icd10_code string, ingestion_ts int, source_file string")
    cat = spark.createDataFrame([("Knee  repair", "ortho", "M17"), ("Other", "skin", "L90")], "procedure_name string, specialty string, icd10_code string")
    got = {r["procedure_code"]: (r["icd10_code"], r["icd10_source"], r["icd10_chapter"], r["icd10_reliability"]) for r in procedures.dim_procedure(procedures.coded(p, cat)).collect()}
    assert got == {"P1": ("M17", "EXACT_NAME", "M", "High"), "P2": ("L90", "GROUP", "L", "Low")}
    assert procedures.coded(p.limit(0), cat).count() == 0


def test_bands(spark):
    ages = spark.createDataFrame([(None,), (0,), (12,), (19,), (39,), (59,), (74,), (75,)], "a int").select(gold.age_band(F.col("a"))).collect()
    assert [r[0] for r in ages] == ["Unknown", "Infant", "Child", "Adolescent", "Adult 20-39", "Adult 40-59", "Senior 60-74", "Elderly 75+"]


def test_recovery_counts_null_as_a_value(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", 1)], "k string, v int")
    b = spark.createDataFrame([("x", None), ("z", 1)], "k string, v int")
    assert [tuple(r) for r in measures.recovery(a, b, ["k", "v"], "m").collect()] == [("m_coverage", 0.5, "1 of 2"), ("m_fidelity", 0.5, "1 of 2")]
    assert measures.recovery(a.limit(0), b.limit(0), ["k"], "m").first()["value"] == 0.0


def test_measures_of_ones_own(spark):
    @measure("longest")
    def longest(df, check):
        return float(df.agg(F.max(F.length(check.columns[0]))).first()[0])

    try:
        got = evaluate(spark, lambda _: spark.createDataFrame([("abc",)], "t string"), [Check("long", "x", "longest", ("t",), threshold=5, compare="lte")]).first()
        assert (got["value"], got["passed"]) == (3.0, True)
        with pytest.raises(ValueError):
            measure("unique")
    finally:
        MEASURES.clear()


def test_config_layers(tmp_path):
    (tmp_path / "a.toml").write_text('landing = "${ROOT}/in"\n[people]\naccept = 0.8\n')
    got = config.load(str(tmp_path / "a.toml"), {"people": {"review": 0.5}}, env={"ROOT": "/r"})
    assert got["landing"] == "/r/in" and got["people"] == {"accept": 0.8, "review": 0.5} and got["links"]["days"] == 2
    with pytest.raises(KeyError):
        config.load(str(tmp_path / "a.toml"), env={})


CONFIG = """
landing = "{root}/landing"
[seeds]
catalogue = "{root}/icd.csv"
[quality]
checks = [{{ name = "person_key", table = "people/master", kind = "unique", columns = ["mpi_id"], blocking = true }}, {{ name = "visit_person", table = "star/fact_patient_visit", kind = "not_null", columns = ["mpi_id"], threshold = {least} }}]
[sources.registrations]
format = "csv"
key = ["hospital_id", "patient_id"]
columns = {{ hospital_id = "string", patient_id = "string", name = "string", dob = "string", phone = "string", city = "string", gender = "string", updated = "timestamp" }}
[sources.doctors]
format = "csv"
key = ["doctor_id"]
columns = {{ doctor_id = "string", department = "string", hospital_id = "string", specialty = "string", designation = "string", effective_date = "date" }}
[sources.claims]
format = "csv"
key = ["claim_id"]
columns = {{ claim_id = "string", claim_status = "string", status_date = "date", export_date = "date", patient_id = "string", hospital_id = "string", insurer_id = "string", claim_amount = "decimal(18,2)", approved_amount = "decimal(18,2)", submitted_date = "date", admission_date = "date", rejection_reason = "string", hospital_ref_no = "string" }}
[sources.bills]
format = "csv"
key = ["bill_id"]
columns = {{ bill_id = "string", hospital_id = "string", admission_date = "date", net_payable = "decimal(18,2)" }}
[sources.procedures]
format = "json"
key = ["procedure_code"]
columns = {{ procedure_code = "string", procedure_name = "string", specialty = "string", icd10_code = "string" }}
[sources.movements]
format = "json"
key = ["event_id"]
columns = {{ event_id = "string", visit_id = "string", hospital_id = "string", ward_id = "string", bed_number = "string", patient_id = "string", event_ts = "timestamp", event_type = "string" }}
[sources.visits]
format = "csv"
key = ["visit_id"]
columns = {{ visit_id = "string", patient_id = "string", hospital_id = "string", doctor_id = "string", admission_date = "date", discharge_date = "date", admission_type = "string" }}
[sources.hospitals]
format = "csv"
key = ["hospital_id"]
columns = {{ hospital_id = "string", hospital_name = "string", bed_capacity = "int" }}
"""


def test_all_layers_by_the_command_line(spark, tmp_path, capsys):
    def put(name, *lines):
        p = tmp_path / "landing" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("\n".join(lines) + "\n")

    put("registrations/r_2024-01-05.csv", "hospital_id,patient_id,name,dob,phone,city,gender,updated", "H1,a,Asha Rao,1980-02-01,9876543210,Pune,F,2024-01-01 00:00:00", "H2,b,ASHA  RAO,1980-02-01,9876543210,Pune,F,2024-01-02 00:00:00", "H1,c,Vikram Nair,,,,,")
    put("doctors/d_2024-01-05.csv", "doctor_id,department,hospital_id,specialty,designation,effective_date", "D1,ENT,H1,ear,Consultant,2023-01-01", "D1,Skin,H1,ear,Head of Department,2024-01-03")
    put("claims/c_2024-01-05.csv", "claim_id,claim_status,status_date,export_date,patient_id,hospital_id,insurer_id,claim_amount,approved_amount,submitted_date,admission_date,rejection_reason,hospital_ref_no", "C1,Submitted,2024-01-02,2024-01-05,a,H1,I1,100,,2024-01-02,2024-01-01,,NH/007")
    put("bills/b_2024-01-05.csv", "bill_id,hospital_id,admission_date,net_payable", "NH-000007,H1,2024-01-01,100")
    put("procedures/p_2024-01-05.json", json.dumps({"procedure_code": "P1", "procedure_name": "Graft - Left", "specialty": "skin", "icd10_code": None}))
    put("movements/m_2024-01-05.json", *[json.dumps({"event_id": str(i), "visit_id": "V1", "hospital_id": "H1", "ward_id": "W1", "bed_number": "1", "patient_id": "a", "event_ts": t, "event_type": k}) for i, (t, k) in enumerate([("2024-01-01T08:00:00", "CHECK_IN"), ("2024-01-03T08:00:00", "CHECK_OUT")])])
    put("visits/v_2024-01-05.csv", "visit_id,patient_id,hospital_id,doctor_id,admission_date,discharge_date,admission_type", "V1,a,H1,D1,2024-01-01,2024-01-03,IPD", "V2,b,H2,D1,2024-01-10,2024-01-12,IPD")
    put("hospitals/h_2024-01-05.csv", "hospital_id,hospital_name,bed_capacity", "H1,One,500", "H2,Two,")
    (tmp_path / "icd.csv").write_text("# catalogue\nprocedure_name,specialty,icd10_code\nGraft,skin,L90\n")
    (tmp_path / "c.toml").write_text(CONFIG.format(root=tmp_path, least=0.9))
    arg = ["run", "all", "--root", str(tmp_path / "store"), "--config", str(tmp_path / "c.toml"), "--date", "2024-01-31"]
    assert main(arg, spark) == 0, capsys.readouterr()
    store = TableStore(spark, str(tmp_path / "store"))
    v = {r["visit_id"]: r for r in store.read("star/fact_patient_visit").collect()}
    assert v["V1"]["department_at_visit"] == "ent" and v["V1"]["department_current"] == "skin" and v["V2"]["department_at_visit"] == "skin"
    assert v["V1"]["mpi_id"] == v["V2"]["mpi_id"] and v["V2"]["readmit_cross_hospital_only"] and not v["V2"]["readmit_30d_same_hospital"]
    assert store.row_count("star/fact_bed_occupancy") == 3 and store.read("star/fact_bed_occupancy").filter("occupancy_rate = 1.0").count() == 3
    assert store.read("links/accepted").first()["bill_id"] == "NH-000007" and store.row_count("star/dim_date") > 1000
    assert {r["size_band"] for r in store.read("star/dim_hospital").collect()} == {"Large", "Unknown"}
    assert store.read(SCORECARD).filter("check_name = 'link_rate' and value = 1.0").count() == 1
    assert main(arg, spark) == 0 and capsys.readouterr().out.count("SKIPPED") >= 15
    assert [r["n_rows"] for r in summary(store, ["claims", "none"]).orderBy("source").collect()] == [1, 0]
    # a late doctor's row and a blocking failure
    put("doctors/d_2024-01-04.csv", "doctor_id,department,hospital_id,specialty,designation,effective_date", "D1,Eye,H1,ear,Consultant,2024-01-01")
    (tmp_path / "d.toml").write_text(CONFIG.format(root=tmp_path, least=0.9).replace('kind = "unique", columns = ["mpi_id"]', 'kind = "row_count", threshold = 99.0'))
    again = [*arg[:5], str(tmp_path / "d.toml"), "--config", str(tmp_path / "d.toml"), "--date", "2024-02-29"]
    assert main(["run", "raw", *again[2:], "--sources", "doctors"], spark) == 0 and main(["run", "resolved", *again[2:], "--steps", "doctors"], spark) == 0
    assert [(r["department"], str(r["valid_from"])) for r in store.read("doctors/versions").orderBy("valid_from").collect()] == [("ent", "2023-01-01"), ("eye", "2024-01-01"), ("skin", "2024-01-03")]
    assert main(["run", "quality", *again[2:]], spark) == 1 and main(["run", "quality", *again[2:], "--no-fail-on-quality"], spark) == 0
    assert main(["run", "resolved", *again[2:], "--steps", "nothing"], spark) == 1
    assert main(["check", "--root", str(tmp_path / "checked")], spark) == 0
    assert parser().parse_args(["run", "star", "--root", "r", "--skip-maintenance"]).skip_maintenance


def test_report_and_export(spark, tmp_path):
    assert main(["report", "--tables", "/root/testdata/sf0.001", "--only", "q_counts", "--out", str(tmp_path / "r.md")], spark) == 0
    assert (tmp_path / "r.md").read_text().startswith("## q_counts") and "| 1 | visits |" in (tmp_path / "r.md").read_text()
    assert main(["report", "--tables", "/root/testdata/sf0.001", "--only", "q_none"], spark) == 1
    assert main(["export", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "p")], spark) == 0 and len(list((tmp_path / "p").glob("*.json"))) == 6
