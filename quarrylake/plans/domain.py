"""Queries p2, p3, p4 and p6 of the network's tables, and the SQL of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import row_hash, same_text
from ..operators.history import History, as_of, periods, snapshot_changes, standing, type2_loads
from ..operators.references import reference_status

VERSIONED = ("department", "hospital_id", "specialty", "designation")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doctor_history(doctors: DataFrame) -> History:
    """The doctors' history: what arrived in the last year merged into the stored history of all years before."""
    last = doctors.agg(F.max(F.year("dw_updated_at")).alias("y")).first()["y"]
    return type2_loads(doctors, F.coalesce(F.year("dw_updated_at") == F.lit(last), F.lit(False)), "doctor_id", "effective_from", "effective_to", {c: same_text(F.col(c)) for c in VERSIONED}, ["dw_updated_at"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every doctor with the first and last day it holds."""
    doctors = table(spark, folder, "dim_doctor")
    versions = doctor_history(doctors).versions
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return versions.select("doctor_id", day("valid_from"), day("valid_to"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Visits whose department_at_visit is not that of the doctor's row that holds on the admission date."""
    doctors = table(spark, folder, "dim_doctor")
    rows = standing(doctors, ["doctor_id", "effective_from"], ["dw_updated_at"], ["effective_to", "doctor_sk", "department"])
    rows = periods(rows, "doctor_id", "effective_from", "effective_to").withColumn("__then", same_text(F.col("department")))
    rows = rows.select("doctor_id", "effective_from", "effective_to", F.col("doctor_sk").alias("__sk"), "__then")
    visits = table(spark, folder, "fact_patient_visit").select("visit_id", "doctor_id", "admission_date", same_text(F.col("department_at_visit")).alias("__said"))
    seen = as_of(visits, rows, "doctor_id", "admission_date", "effective_from", "effective_to", ["__sk", "__then"])
    wrong = seen.filter(~F.col("__then").eqNullSafe(F.col("__said")))
    return wrong.select("visit_id", F.col("__sk").alias("doctor_sk")).distinct()


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """References of the two fact tables without a proper target, with table and month."""
    visits, steps = table(spark, folder, "fact_patient_visit"), table(spark, folder, "fact_claim_lifecycle")
    doctors, hospitals, claims = (table(spark, folder, t) for t in ("dim_doctor", "dim_hospital", "claims"))
    latest = claims.agg(F.max("export_date")).first()[0]
    late = ("late", F.col("__first") > F.col("dw_updated_at"))
    gone = ("deleted", F.col("__deleted").cast("timestamp_ntz") <= F.col("dw_updated_at"))
    unlisted = ("deleted", ~F.coalesce(F.col("__listed") >= F.lit(latest).cast("date"), F.lit(False)))
    first = F.min("dw_updated_at")
    out = None
    for facts, name, field, key, on, target, about, kinds in (
        (visits, "fact_patient_visit", "doctor_sk", "visit_id", "admission_date", doctors, {"__first": first}, [late]),
        (visits, "fact_patient_visit", "hospital_sk", "visit_id", "admission_date", hospitals, {"__first": first, "__deleted": F.min("deleted_on")}, [gone, late]),
        (steps, "fact_claim_lifecycle", "claim_id", "transition_key", "status_date", claims, {"__first": F.min("ingestion_ts"), "__listed": F.max("export_date")}, [unlisted, late]),
    ):
        refs = facts.select(F.col(key).alias("record_key"), F.date_format(on, "yyyy-MM").alias("ref_month"), field, "dw_updated_at")
        found = reference_status(refs, target, field, field, about, kinds)
        found = found.select(F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), "record_key", "ref_month", "orphan_kind")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references counted per table, field, month and kind."""
    by = ("table_name", "field_name", "ref_month", "orphan_kind")
    return p4_found(spark, folder).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Claims added, removed or changed from each snapshot of the two tables to the next."""
    claims, life = table(spark, folder, "claims"), table(spark, folder, "claim_lifecycle")
    state = row_hash([same_text(F.col("final_status")), F.col("claim_amount"), F.col("approved_amount"), F.col("rejection_reason")])
    rows = claims.select("claim_id", "export_date", "ingestion_ts", state.alias("__state"))
    rows = standing(rows, ["claim_id", "export_date"], ["ingestion_ts"], ["__state"])
    steps = life.select("claim_id", "rebuilt_on", row_hash([F.col("status_code"), F.col("status_date")]).alias("__step")).dropna(subset=["claim_id", "rebuilt_on"]).distinct()
    # a set of any size as numbers of fixed size that do not depend on order
    part = lambda at: F.conv(F.substring("__step", at, 12), 16, 10).cast("decimal(38,0)")
    digest = F.concat_ws("-", F.count(F.lit(1)), F.sum(part(1)), F.sum(part(13)), F.bit_xor(F.xxhash64("__step")))
    sets = steps.groupBy("claim_id", "rebuilt_on").agg(digest.alias("__state"))
    out = None
    for name, snaps, on, dates in (("claims", rows, "export_date", claims), ("claim_lifecycle", sets, "rebuilt_on", life)):
        found = snapshot_changes(snaps, "claim_id", on, "__state", dates)
        day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
        found = found.select(F.lit(name).alias("table_name"), "claim_id", day("from_snapshot"), day("to_snapshot"), "change_kind")
        out = found if out is None else out.unionByName(found)
    return out


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_report": p4_report, "p6_found": p6_found}

_SAME = "lower(trim(regexp_replace({}, '\\s+', ' ', 'g')))"
_STANDING = """
standing as (
  select * from (select *, row_number() over (partition by doctor_id, effective_from order by dw_updated_at desc) as rn
                 from dim_doctor where doctor_id is not null and effective_from is not null) where rn = 1),
held as (
  select *, least(coalesce(effective_to, date '9999-12-31'), coalesce(cast(lead(effective_from) over (partition by doctor_id order by effective_from) - interval 1 day as date), date '9999-12-31')) as holds_to
  from standing)"""

_P4 = f"""
with d as (select doctor_sk, min(dw_updated_at) as first_seen from dim_doctor group by 1),
h as (select hospital_sk, min(dw_updated_at) as first_seen, min(deleted_on) as deleted_on from dim_hospital group by 1),
c as (select claim_id, min(ingestion_ts) as first_seen, max(export_date) as listed from claims group by 1),
found as (
  select 'fact_patient_visit' as table_name, 'doctor_sk' as field_name, visit_id as record_key, strftime(admission_date, '%Y-%m') as ref_month,
    case when d.doctor_sk is null then 'missing' when d.first_seen > f.dw_updated_at then 'late' end as orphan_kind
  from fact_patient_visit f left join d on f.doctor_sk = d.doctor_sk where f.doctor_sk is not null
  union all
  select 'fact_patient_visit', 'hospital_sk', visit_id, strftime(admission_date, '%Y-%m'),
    case when h.hospital_sk is null then 'missing' when cast(h.deleted_on as timestamp) <= f.dw_updated_at then 'deleted' when h.first_seen > f.dw_updated_at then 'late' end
  from fact_patient_visit f left join h on f.hospital_sk = h.hospital_sk where f.hospital_sk is not null
  union all
  select 'fact_claim_lifecycle', 'claim_id', transition_key, strftime(status_date, '%Y-%m'),
    case when c.claim_id is null then 'missing' when c.listed is distinct from (select max(export_date) from claims) then 'deleted' when c.first_seen > f.dw_updated_at then 'late' end
  from fact_claim_lifecycle f left join c on f.claim_id = c.claim_id where f.claim_id is not null)
"""

ORACLE = {
    "p2_found": f"""
with {_STANDING},
told as (
  select doctor_id, effective_from, holds_to, {", ".join(_SAME.format(c) + " as " + c for c in VERSIONED)}
  from held where holds_to >= effective_from),
marked as (
  select *, case when lag(holds_to) over w + interval 1 day = effective_from
      and {" and ".join(f"lag({c}) over w is not distinct from {c}" for c in VERSIONED)} then 0 else 1 end as fresh
  from told window w as (partition by doctor_id order by effective_from)),
numbered as (select *, sum(fresh) over (partition by doctor_id order by effective_from rows unbounded preceding) as version from marked)
select doctor_id, strftime(min(effective_from), '%Y-%m-%d') as valid_from, strftime(max(holds_to), '%Y-%m-%d') as valid_to
from numbered group by doctor_id, version""",
    "p3_found": f"""
with {_STANDING}
select distinct v.visit_id, h.doctor_sk
from fact_patient_visit v join held h on v.doctor_id = h.doctor_id and v.admission_date between h.effective_from and h.holds_to
where {_SAME.format("h.department")} is distinct from {_SAME.format("v.department_at_visit")}""",
    "p4_found": f"{_P4} select distinct * from found where orphan_kind is not null",
    "p4_report": f"{_P4} select table_name, field_name, ref_month, orphan_kind, count(*) as n from (select distinct * from found where orphan_kind is not null) group by 1, 2, 3, 4",
    "p6_found": f"""
with c as (
  select claim_id, export_date as snap, concat_ws('|', coalesce({_SAME.format("final_status")}, '~'), coalesce(cast(claim_amount as varchar), '~'), coalesce(cast(approved_amount as varchar), '~'), coalesce(rejection_reason, '~')) as state
  from (select *, row_number() over (partition by claim_id, export_date order by ingestion_ts desc, concat_ws('|', final_status, claim_amount, approved_amount, rejection_reason) desc) as rn from claims
        where claim_id is not null and export_date is not null) where rn = 1),
l as (
  select claim_id, rebuilt_on as snap, string_agg(step, ';' order by step) as state
  from (select distinct claim_id, rebuilt_on, concat_ws('|', coalesce(status_code, '~'), coalesce(cast(status_date as varchar), '~')) as step from claim_lifecycle
        where claim_id is not null and rebuilt_on is not null) group by 1, 2),
s as (select 'claims' as table_name, * from c union all select 'claim_lifecycle', * from l),
d as (select *, lead(snap) over (partition by table_name order by snap) as after from (select distinct table_name, snap from s)),
a as (select s.table_name, s.claim_id, d.snap as f, d.after as t, s.state from s join d on s.table_name = d.table_name and s.snap = d.snap where d.after is not null),
b as (select s.table_name, s.claim_id, d.snap as f, d.after as t, s.state from s join d on s.table_name = d.table_name and s.snap = d.after)
select coalesce(a.table_name, b.table_name) as table_name, coalesce(a.claim_id, b.claim_id) as claim_id,
  strftime(coalesce(a.f, b.f), '%Y-%m-%d') as from_snapshot, strftime(coalesce(a.t, b.t), '%Y-%m-%d') as to_snapshot,
  case when a.claim_id is null then 'added' when b.claim_id is null then 'removed' else 'changed' end as change_kind
from a full join b on a.table_name = b.table_name and a.claim_id = b.claim_id and a.f = b.f
where a.claim_id is null or b.claim_id is null or a.state <> b.state""",
}
