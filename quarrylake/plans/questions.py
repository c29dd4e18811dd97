"""SQL questions over the network's tables: the same text runs on Spark and on the engine that checks it.

Questions are registered by name; `answer` runs one, `panels` groups them for the JSON export.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import markdown
from .domain import table

TABLES = ("fact_patient_visit", "fact_claim_lifecycle", "dim_hospital", "dim_doctor", "claims", "bills", "patient_master")

QUESTIONS = {
    "q_visits_by_hospital": """
SELECT h.hospital_name, count(DISTINCT v.visit_id) AS visits, count(DISTINCT v.mpi_id) AS people, round(avg(CASE WHEN v.is_inpatient THEN 1e0 ELSE 0e0 END), 4) AS inpatient_rate
FROM fact_patient_visit v JOIN dim_hospital h ON v.hospital_sk = h.hospital_sk GROUP BY h.hospital_name ORDER BY visits DESC, h.hospital_name""",
    "q_repeat_rates": """
WITH d AS (SELECT DISTINCT visit_id, mpi_id, hospital_id, admission_date, discharge_date, is_inpatient FROM fact_patient_visit WHERE mpi_id IS NOT NULL),
g AS (SELECT hospital_id, is_inpatient, datediff('day', lag(discharge_date) OVER (PARTITION BY mpi_id ORDER BY admission_date, visit_id), admission_date) AS network_gap,
  datediff('day', lag(discharge_date) OVER (PARTITION BY mpi_id, hospital_id ORDER BY admission_date, visit_id), admission_date) AS own_gap FROM d)
SELECT hospital_id, count(*) AS visits, round(avg(CASE WHEN is_inpatient AND network_gap BETWEEN 0 AND 30 THEN 1e0 ELSE 0e0 END), 6) AS network_rate, round(avg(CASE WHEN is_inpatient AND own_gap BETWEEN 0 AND 30 THEN 1e0 ELSE 0e0 END), 6) AS own_rate
FROM g GROUP BY hospital_id ORDER BY hospital_id""",
    "q_monthly": """
SELECT year(admission_date) AS y, month(admission_date) AS m, count(DISTINCT visit_id) AS visits, sum(CASE WHEN is_inpatient THEN 1 ELSE 0 END) AS inpatient_rows FROM fact_patient_visit GROUP BY 1, 2 ORDER BY 1, 2""",
    "q_department_shift": """
WITH a AS (SELECT upper(trim(department_at_visit)) AS d, count(*) AS n FROM fact_patient_visit GROUP BY 1), b AS (SELECT upper(trim(department_current)) AS d, count(*) AS n FROM fact_patient_visit GROUP BY 1)
SELECT coalesce(a.d, b.d) AS department, coalesce(a.n, 0) AS n_then, coalesce(b.n, 0) AS n_now, round(abs(coalesce(b.n, 0) - coalesce(a.n, 0)) * 1.0 / nullif(a.n, 0), 4) AS shift FROM a FULL OUTER JOIN b ON a.d = b.d ORDER BY department""",
    "q_journey": """
WITH s AS (SELECT claim_id, min(CASE WHEN status_code = 'Submitted' THEN status_date END) AS a, max(CASE WHEN status_code = 'Settled' THEN status_date END) AS b, max(insurer_id) AS insurer_id FROM fact_claim_lifecycle WHERE claim_id IS NOT NULL GROUP BY claim_id)
SELECT insurer_id, count(*) AS claims, sum(CASE WHEN b IS NOT NULL THEN 1 ELSE 0 END) AS settled, min(datediff('day', a, b)) AS quickest, max(datediff('day', a, b)) AS slowest FROM s GROUP BY insurer_id HAVING count(*) >= 5 ORDER BY insurer_id""",
    "q_reasons": """
SELECT rejection_reason, count(DISTINCT claim_id) AS claims, count(DISTINCT insurer_id) AS insurers, count(DISTINCT hospital_id) AS hospitals, CASE WHEN count(DISTINCT hospital_id) >= 20 THEN 'systemic' ELSE 'local' END AS spread FROM claims WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason ORDER BY claims DESC, rejection_reason LIMIT 10""",
    "q_stages": """
SELECT status_code, count(DISTINCT claim_id) AS claims, round(avg(days_in_prev_status), 4) AS mean_days, cast(median(days_in_prev_status) AS double) AS median_days FROM fact_claim_lifecycle GROUP BY status_code ORDER BY status_code""",
    "q_spread": "SELECT source_hospital_count AS hospitals, count(DISTINCT mpi_id) AS people FROM patient_master GROUP BY 1 ORDER BY 1",
    "q_busy_doctors": """
SELECT doctor_id, count(DISTINCT visit_id) AS visits, count(DISTINCT mpi_id) AS people, round(count(DISTINCT visit_id) * 1.0 / nullif(count(DISTINCT mpi_id), 0), 4) AS per_person FROM fact_patient_visit WHERE doctor_id IS NOT NULL GROUP BY doctor_id HAVING count(DISTINCT visit_id) >= 10 ORDER BY visits DESC, doctor_id LIMIT 30""",
    "q_hospitals": "SELECT hospital_id, hospital_name, tier, bed_capacity FROM dim_hospital WHERE dw_updated_at = (SELECT max(d.dw_updated_at) FROM dim_hospital d) OR deleted_on IS NULL ORDER BY hospital_id",
    "q_counts": """
SELECT 1 AS seq, 'visits' AS what, (SELECT count(*) FROM fact_patient_visit) AS n UNION ALL SELECT 2, 'claims', (SELECT count(DISTINCT claim_id) FROM claims) UNION ALL SELECT 3, 'bills', (SELECT count(DISTINCT bill_id) FROM bills) UNION ALL SELECT 4, 'doctors', (SELECT count(DISTINCT doctor_id) FROM dim_doctor)""",
    "q_settlement": """
WITH c AS (SELECT claim_id, max(insurer_id) AS insurer_id, max(CASE WHEN status_code = 'Settled' THEN 1 ELSE 0 END) AS settled, max(CASE WHEN status_code = 'Rejected' THEN 1 ELSE 0 END) AS rejected FROM fact_claim_lifecycle WHERE claim_id IS NOT NULL GROUP BY claim_id),
r AS (SELECT insurer_id, count(*) AS claims, round(100.0 * sum(settled) / count(*), 2) AS settlement_pct, round(100.0 * sum(rejected) / count(*), 2) AS rejection_pct FROM c GROUP BY insurer_id),
d AS (SELECT insurer_id, prev_status AS stage, cast(median(days_in_prev_status) AS double) AS median_days, count(*) AS moves FROM fact_claim_lifecycle WHERE prev_status IS NOT NULL AND days_in_prev_status IS NOT NULL GROUP BY insurer_id, prev_status)
SELECT d.insurer_id, d.stage, d.median_days, d.moves, r.claims, r.settlement_pct, r.rejection_pct FROM d JOIN r ON d.insurer_id = r.insurer_id ORDER BY d.insurer_id, d.median_days DESC, d.stage""",
    "q_headline": """
SELECT count(DISTINCT visit_id) AS visits, count(DISTINCT mpi_id) AS people, count(DISTINCT CASE WHEN is_inpatient THEN visit_id END) AS inpatient_visits, count(DISTINCT doctor_id) AS doctors FROM fact_patient_visit""",
    "q_misattributed": """
WITH a AS (SELECT upper(trim(department_at_visit)) AS d, count(*) AS n FROM fact_patient_visit WHERE department_at_visit IS NOT NULL GROUP BY 1), b AS (SELECT upper(trim(department_current)) AS d, count(*) AS n FROM fact_patient_visit WHERE department_current IS NOT NULL GROUP BY 1)
SELECT sum(abs(coalesce(b.n, 0) - coalesce(a.n, 0))) AS misattributed, sum(coalesce(a.n, 0)) AS attributed FROM a FULL OUTER JOIN b ON a.d = b.d""",
    "q_claim_totals": """
SELECT count(DISTINCT claim_id) AS claims, count(DISTINCT CASE WHEN is_terminal THEN claim_id END) AS ended, round(avg(CASE WHEN is_legal_transition THEN 1e0 ELSE 0e0 END), 6) AS legal_rate FROM fact_claim_lifecycle""",
    "q_top_procedures": """
WITH v AS (SELECT DISTINCT visit_id, procedure_code, length_of_stay FROM fact_patient_visit WHERE is_inpatient AND procedure_code IS NOT NULL)
SELECT procedure_code, count(*) AS episodes, round(avg(length_of_stay), 4) AS mean_stay FROM v GROUP BY procedure_code HAVING count(*) >= 5 ORDER BY episodes DESC, procedure_code LIMIT 12""",
    "q_occupancy_grid": """
WITH v AS (SELECT DISTINCT visit_id, hospital_id, admission_type, length_of_stay FROM fact_patient_visit WHERE is_inpatient)
SELECT h.hospital_name, v.admission_type, count(*) AS stays, sum(v.length_of_stay) AS bed_days, round(sum(v.length_of_stay) * 100.0 / nullif(max(h.bed_capacity) * 365, 0), 4) AS occupancy_pct FROM v JOIN dim_hospital h ON v.hospital_id = h.hospital_id GROUP BY h.hospital_name, v.admission_type ORDER BY h.hospital_name, v.admission_type""",
    "q_occupancy_months": """
WITH v AS (SELECT DISTINCT visit_id, admission_type, admission_date, length_of_stay FROM fact_patient_visit WHERE is_inpatient AND admission_date IS NOT NULL)
SELECT year(admission_date) AS y, month(admission_date) AS m, admission_type, sum(length_of_stay) AS bed_days FROM v GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "q_insurers": "SELECT insurer_id, count(DISTINCT claim_id) AS claims, count(DISTINCT hospital_id) AS hospitals FROM claims WHERE insurer_id IS NOT NULL GROUP BY insurer_id ORDER BY insurer_id",
    "q_code_provenance": """
SELECT CASE WHEN procedure_code IS NULL THEN 'NONE' ELSE 'SOURCE' END AS provenance, count(DISTINCT visit_id) AS visits FROM fact_patient_visit GROUP BY 1 ORDER BY visits DESC, provenance""",
    "q_checks": """
SELECT 'visit_key' AS check_name, round(count(DISTINCT visit_id) * 1e0 / nullif(count(*), 0), 6) AS value, 1e0 AS threshold, count(DISTINCT visit_id) = count(*) AS passed FROM fact_patient_visit
UNION ALL SELECT 'visit_person', round(count(mpi_id) * 1e0 / nullif(count(*), 0), 6), 0.95e0, count(mpi_id) * 1e0 / nullif(count(*), 0) >= 0.95 FROM fact_patient_visit
UNION ALL SELECT 'claim_status', round(count(final_status) * 1e0 / nullif(count(*), 0), 6), 0.99e0, count(final_status) * 1e0 / nullif(count(*), 0) >= 0.99 FROM claims
UNION ALL SELECT 'move_is_legal', round(avg(CASE WHEN is_legal_transition THEN 1e0 ELSE 0e0 END), 6), 1e0, avg(CASE WHEN is_legal_transition THEN 1e0 ELSE 0e0 END) >= 1 FROM fact_claim_lifecycle
ORDER BY passed, check_name""",
    "q_checks_summary": """
WITH q AS (SELECT 'visit_key' AS check_name, count(DISTINCT visit_id) = count(*) AS passed, true AS blocking FROM fact_patient_visit
UNION ALL SELECT 'visit_person', count(mpi_id) >= 0.95 * count(*), false FROM fact_patient_visit UNION ALL SELECT 'claim_status', count(final_status) >= 0.99 * count(*), false FROM claims)
SELECT count(*) AS total, sum(CASE WHEN passed THEN 1 ELSE 0 END) AS passed, sum(CASE WHEN NOT passed AND blocking THEN 1 ELSE 0 END) AS blocking_failures, sum(CASE WHEN NOT passed AND NOT blocking THEN 1 ELSE 0 END) AS warnings FROM q""",
    "q_payment_modes": "SELECT payment_mode, count(DISTINCT bill_id) AS bills FROM bills GROUP BY payment_mode ORDER BY payment_mode",
    "q_insurer_months": """
SELECT insurer_id, year(submitted_date) AS y, month(submitted_date) AS m, count(DISTINCT claim_id) AS claims FROM claims WHERE submitted_date IS NOT NULL GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "q_above_median": """
WITH n AS (SELECT hospital_id, count(DISTINCT visit_id) AS visits FROM fact_patient_visit GROUP BY hospital_id), m AS (SELECT cast(median(visits) AS double) AS mid FROM n)
SELECT n.*, m.mid FROM n CROSS JOIN m WHERE n.visits > m.mid ORDER BY n.visits DESC, n.hospital_id""",
}

PANELS = {
    "headline": ("q_headline", "q_misattributed", "q_claim_totals"),
    "clinical": ("q_visits_by_hospital", "q_repeat_rates", "q_monthly", "q_spread", "q_top_procedures"),
    "operational": ("q_department_shift", "q_busy_doctors", "q_above_median", "q_occupancy_grid", "q_occupancy_months"),
    "claims": ("q_journey", "q_reasons", "q_stages", "q_settlement"),
    "quality": ("q_checks", "q_checks_summary"),
    "reference": ("q_hospitals", "q_counts", "q_insurers", "q_code_provenance", "q_payment_modes"),
}

#: The checking engine's name for the function, where it differs.
_TWIN = {"datediff('day',": "date_diff('day',"}


def answer(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One question over the Parquet tables of a folder, which are bound to the names in its text."""
    sql = QUESTIONS[name].replace("datediff('day',", "datediff(DAY,")
    args = {t: table(spark, folder, t) for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)}
    for t in args:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **args)


def panels(spark: SparkSession, folder: str) -> dict[str, dict[str, DataFrame]]:
    """The questions of each panel, for `sinks.write_panels`."""
    return {p: {n: answer(spark, folder, n) for n in names} for p, names in PANELS.items()}


def report(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> str:
    """Markdown with a section for each question (all, or those named): its SQL and its rows."""
    unknown = set(only or ()) - set(QUESTIONS)
    if unknown:
        raise ValueError(f"no such questions: {sorted(unknown)}")
    names = [n for n in QUESTIONS if not only or n in only]
    return "\n\n".join(f"## {n}\n\n```sql\n{QUESTIONS[n].strip()}\n```\n\n{markdown(answer(spark, folder, n))}" for n in names) + "\n"


def _run(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return answer(spark, folder, name)

    run.__doc__ = f"The question {name}."
    return run


def _twin(sql: str) -> str:
    for a, b in _TWIN.items():
        sql = sql.replace(a, b)
    return sql


QUERIES = {n: _run(n) for n in QUESTIONS}
ORACLE = {n: _twin(s) for n, s in QUESTIONS.items()}
