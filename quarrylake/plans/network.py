"""Queries for the pipeline's composites over the network's tables, each with its SQL where the other engine can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import first_by
from ..pipeline import claims, gold, links, measures, people, procedures, rules, stays
from ..session import written
from .domain import _SAME, _STANDING, VERSIONED, doctor_history, table
from .star import _norm, _sound, _store, big, text_day

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- people ---------------------------------------------------------------------------------------------------------


def _raw_registrations(spark: SparkSession, folder: str) -> DataFrame:
    """Registrations of the crosswalk with city and gender of the person that each was given."""
    w = table(spark, folder, "patient_crosswalk").select("hospital_id", "patient_id", "mpi_id", F.col("full_name_norm").alias("name"), F.col("dob_parsed").alias("dob"), F.col("phone_norm").alias("phone"), F.col("matched_at").alias("updated"))
    m = table(spark, folder, "patient_master").filter("mpi_id is not null").groupBy("mpi_id").agg(F.min("city").alias("city"), F.min("gender").alias("gender"))
    return w.join(m, "mpi_id", "left")


def _regs(spark, folder):
    return people.registrations(_raw_registrations(spark, folder))


def _key(*cols: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in cols) + ")"


_REGS = f"""
raw as (select w.hospital_id, w.patient_id, w.full_name_norm as name, w.dob_parsed as dob, w.phone_norm as phone, m.city, m.gender, w.matched_at as updated
  from patient_crosswalk w left join (select mpi_id, min(city) as city, min(gender) as gender from patient_master where mpi_id is not null group by 1) m on w.mpi_id = m.mpi_id where w.hospital_id is not null and w.patient_id is not null),
latest as (select * from (select *, row_number() over (partition by hospital_id, patient_id order by updated desc nulls last, {" || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("city", "dob", "gender", "hospital_id", "name", "patient_id", "phone"))}) as rn from raw) where rn = 1),
formed as (select *, {_key("hospital_id", "patient_id")} as record_id, nullif({_norm("name")}, '') as full_name, regexp_replace(phone, '[^0-9]', '', 'g') as digits from latest),
regs as (select record_id, hospital_id, patient_id, full_name, split_part(full_name, ' ', 1) as first_name, case when full_name like '% %' then split_part(full_name, ' ', -1) end as last_name, dob,
  case when length(digits) >= 10 then right(digits, 10) end as phone, nullif(upper(trim(city)), '') as city, nullif(left(upper(trim(gender)), 1), '') as gender, updated,
  case when full_name is not null and dob is not null and length(digits) >= 10 then sha256(length(full_name) || ':' || full_name || '10:' || dob::varchar || '4:' || right(digits, 4)) end as exact_key from formed)"""


@query(f"with {_REGS} select record_id, hospital_id, patient_id, full_name, first_name, last_name, strftime(dob, '%Y-%m-%d') as dob, phone, right(phone, 4) as phone_last4, city, gender, exact_key from regs")
def registrations(spark, folder):
    """Latest registrations in normal form."""
    return _regs(spark, folder).select("record_id", "hospital_id", "patient_id", "full_name", "first_name", "last_name", text_day("dob"), "phone", "phone_last4", "city", "gender", "exact_key")


_PAIRS = f"""{_REGS},
cls as (select *, min(record_id) over (partition by full_name, dob, phone, city, gender) as class_id from regs),
head as (select *, {_sound("first_name")} as s1, {_sound("last_name")} as s2 from cls where class_id = record_id),
k as (select record_id as r, 'phone' as s, phone as b from head union all select record_id, 'sound_date', s1 || '|' || dob::varchar from head
  union all select record_id, 'sounds_year', s1 || '|' || s2 || '|' || year(dob)::varchar from head union all select record_id, 'sounds_city', s1 || '|' || s2 || '|' || city from head),
pairs as (select x.r as a, y.r as b, string_agg(distinct x.s, ',' order by x.s) as strategies from k x join k y on x.s = y.s and x.b = y.b and x.r < y.r group by 1, 2)"""


@query(f"with {_PAIRS} select * from pairs")
def people_candidates(spark, folder):
    """Pairs of registrations by phone, sounds and birth date, year or city; copies stand for one."""
    return people.candidates(_regs(spark, folder)).withColumn("strategies", F.array_join("strategies", ","))


_SCORED = f"""{_PAIRS},
p as (select pairs.*, round(jaro_winkler_similarity(coalesce(x.full_name, ''), coalesce(y.full_name, '')), 6) as name_sim,
  case when x.dob is null or y.dob is null then null when x.dob = y.dob then 1.0 when (year(x.dob) = year(y.dob) and month(x.dob) = day(y.dob) and day(x.dob) = month(y.dob)) or abs(date_diff('day', x.dob, y.dob)) <= 1 then 0.75 when year(x.dob) = year(y.dob) then 0.35 else 0.0 end as dob_sim,
  case when x.phone is null or y.phone is null then null when x.phone = y.phone then 1.0 when levenshtein(x.phone, y.phone) = 1 or (levenshtein(x.phone, y.phone) = 2 and list_sort(string_split(x.phone, '')) = list_sort(string_split(y.phone, ''))) then 0.85 when levenshtein(x.phone, y.phone) = 2 then 0.45 else 0.0 end as phone_sim,
  case when x.city is null or y.city is null then null when x.city = y.city then 1.0 else 0.0 end as city_sim, coalesce(x.gender <> y.gender, false) as gender_conflict
  from pairs join regs x on x.record_id = a join regs y on y.record_id = b),
q as (select *, round((name_sim * 0.4::double + coalesce(dob_sim * 0.3::double, 0) + coalesce(phone_sim * 0.2::double, 0) + coalesce(city_sim * 0.1::double, 0)) / (0.4::double + case when dob_sim is null then 0 else 0.3::double end + case when phone_sim is null then 0 else 0.2::double end + case when city_sim is null then 0 else 0.1::double end), 4) as raw_score from p),
scored as (select * exclude (raw_score), case when gender_conflict and name_sim < 0.95 then raw_score * 0.5 else raw_score end as match_score from q)"""


@query(f"with {_SCORED} select a, b, name_sim, dob_sim::double as dob_sim, phone_sim::double as phone_sim, city_sim::double as city_sim, gender_conflict, match_score, case when match_score >= 0.9 then 'match' when match_score >= 0.75 then 'review' else 'none' end as outcome from scored")
def people_scored(spark, folder):
    """Candidate pairs with their parts, score and outcome."""
    from ..operators.entity import three_way

    regs = written(_regs(spark, folder), "registrations")
    return people.score(written(people.candidates(regs), "pairs"), regs).withColumn("outcome", three_way(F.col("match_score"), people.ACCEPT, people.REVIEW)).drop("strategies")


_PEOPLE = f"""with recursive {_SCORED},
l0 as (select a, b, match_score from scored where match_score >= 0.9 union all select class_id, record_id, 1.0 from cls where class_id <> record_id
  union all select least_id, record_id, 1.0 from (select record_id, min(record_id) over (partition by exact_key) as least_id from regs where exact_key is not null) where least_id <> record_id),
e as (select a as x, b as y from l0 union select b, a from l0),
r(x, y) as (select record_id, record_id from regs union select r.x, e.y from r join e on r.y = e.x),
g as (select x as record_id, min(y) as label from r group by 1),
best as (select record_id, max(match_score)::double as match_score from (select a as record_id, match_score from l0 union all select b, match_score from l0) group by 1)"""


def _resolved(spark, folder):
    """The network's people resolved twice into a store: the second run must change nothing."""
    store = _store(spark)
    regs = written(_regs(spark, folder), "registrations")
    for _ in range(2):
        people.resolve(store, regs)
    return store


@query(f"{_PEOPLE} select hospital_id, patient_id, label, exact_key is not null as had_exact_key, match_score from regs join g using (record_id) left join best using (record_id)")
def people_crosswalk(spark, folder):
    """Registrations with their person, told by its least record (ids are minted by hash), and the evidence."""
    w = _resolved(spark, folder).read(people.CROSSWALK)
    least = w.groupBy("mpi_id").agg(F.min("record_id").alias("label"))
    return w.join(least, "mpi_id").select("hospital_id", "patient_id", "label", "had_exact_key", "match_score")


@query(f"""{_PEOPLE}, m as (select *, row_number() over (partition by label order by updated desc nulls last, record_id) as rn, count(*) over (partition by label) as n from regs join g using (record_id)),
h as (select label, count(distinct hospital_id) as hospitals from m group by 1) select label, full_name, strftime(dob, '%Y-%m-%d') as dob, n as source_record_count, hospitals as source_hospital_count from m join h using (label) where rn = 1""")
def people_master(spark, folder):
    """People with the newest registration and how many there are."""
    store = _resolved(spark, folder)
    least = store.read(people.CROSSWALK).groupBy("mpi_id").agg(F.min("record_id").alias("label"))
    return store.read(people.MASTER).join(least, "mpi_id").select("label", "full_name", text_day("dob"), "source_record_count", *big("source_hospital_count"))


# --- claims ---------------------------------------------------------------------------------------------------------

_STYLE = "list_reduce(list_transform(string_split(lower(trim(regexp_replace(final_status, '\\s+', ' ', 'g'))), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), lambda x, y: x || ' ' || y)"
_AUDIT = f"""
c as (select *, {_STYLE} as status_code from claims where claim_id is not null and trim(final_status) <> ''),
t as (select {_key("claim_id", "status_code", "status_date")} as transition_key, claim_id, status_code, status_date, min(export_date) as first_observed_export from c group by claim_id, status_code, status_date)"""
_ORDER = "(partition by claim_id order by status_date nulls first, status_code, transition_key)"


def _moves(sets: dict) -> str:
    return " or ".join(f"(prev_status = '{s}' and status_code in ({', '.join(repr(x) for x in sorted(t))}))" for s, t in sets.items() if t)


def _life_sql() -> str:
    from ..operators.states import closure

    return f"""{_AUDIT},
n as (select *, row_number() over w as transition_seq, lag(status_code) over w as prev_status, lead(status_code) over w as next_status, date_diff('day', lag(status_date) over w, status_date) as days_in_prev_status, status_code in ('Settled', 'Rejected') as is_terminal from t window w as {_ORDER}),
life as (select *, case when prev_status is null then 'INITIAL' when {_moves(claims.MOVES)} then 'DIRECT' when {_moves(closure(claims.MOVES))} then 'GAP' else 'ILLEGAL' end as transition_class from n)"""


@query(f"with {_AUDIT} select transition_key, claim_id, status_code, strftime(status_date, '%Y-%m-%d') as status_date, strftime(first_observed_export, '%Y-%m-%d') as first_observed_export from t")
def claim_transitions(spark, folder):
    """Different transitions of all claims with the export in which each was first seen."""
    t = claims.transitions(claims.normalized(table(spark, folder, "claims")))
    return t.select("transition_key", "claim_id", "status_code", text_day("status_date"), text_day("first_observed_export"))


def _lifecycle(spark, folder, store=None):
    """The lifecycle after the exports have come in three loads, the latest first, and one of them twice."""
    store = store or _store(spark)
    c = claims.normalized(table(spark, folder, "claims"))
    for part in ("export_date >= '2024-01-01'", "export_date < '2023-01-01' or export_date is null", "export_date >= '2023-01-01' and export_date < '2024-01-01'", "export_date >= '2024-01-01'"):
        claims.take(store, c.filter(part))
    return store.read(claims.LIFECYCLE)


@query(f"with {_life_sql()} select transition_key, claim_id, transition_seq, prev_status, next_status, days_in_prev_status, is_terminal, transition_class, transition_class <> 'ILLEGAL' as is_legal_transition from life")
def claim_lifecycle_late(spark, folder):
    """Order and class of all transitions although exports arrived late: claims are renumbered from the audit."""
    return _lifecycle(spark, folder).select("transition_key", "claim_id", *big("transition_seq"), "prev_status", "next_status", *big("days_in_prev_status"), "is_terminal", "transition_class", "is_legal_transition")


_LAST_REBUILD = "l as (select distinct claim_id, status_code, status_date from claim_lifecycle where rebuilt_on = (select max(rebuilt_on) from claim_lifecycle))"


@query(f"""with {_AUDIT}, {_LAST_REBUILD}, f as (select distinct claim_id, status_code, status_date from t),
n as (select (select count(*) from f) as f, (select count(*) from l) as l, (select count(*) from f join l on f.claim_id is not distinct from l.claim_id and f.status_code is not distinct from l.status_code and f.status_date is not distinct from l.status_date) as b)
select 'claims_coverage' as check_name, round(b / l::double, 6) as value, b || ' of ' || l as detail from n union all select 'claims_fidelity', round(b / f::double, 6), b || ' of ' || f from n""")
def claim_recovery(spark, folder):
    """How many of the transitions of the last rebuild the exports tell, and how many that they tell are in it."""
    life = table(spark, folder, "claim_lifecycle")
    last = life.join(F.broadcast(life.agg(F.max("rebuilt_on").alias("rebuilt_on"))), "rebuilt_on")  # one row
    return measures.recovery(claims.transitions(claims.normalized(table(spark, folder, "claims"))), last, ["claim_id", "status_code", "status_date"], "claims")


@query(f"""with {_life_sql()}, g as (select claim_id, max(is_terminal::int) as t, sum((transition_class = 'ILLEGAL')::int) as i from life group by 1), m as (select count(*) as n, sum(t) as t, sum(i) as i from g)
select 'terminal_state_rate' as check_name, round(t / n::double, 6) as value, t || ' of ' || n as detail from m union all select 'illegal_transitions', i::double, i::varchar from m""")
def claim_health(spark, folder):
    """Share of claims that came to an end, and moves that can't be."""
    return measures.lifecycle_health(claims.enriched(claims.transitions(claims.normalized(table(spark, folder, "claims")))))


# --- bills ----------------------------------------------------------------------------------------------------------

_TAIL = "try_cast(nullif(regexp_extract({}, '([0-9]+)[^0-9]*$', 1), '') as bigint)"
_ROUTES = f"""
c0 as (select * from (select *, row_number() over (partition by claim_id order by export_date desc, ingestion_ts desc, coalesce(hospital_ref_no, '')) as rn from claims where claim_id is not null) where rn = 1),
c as (select claim_id, hospital_id, {_TAIL.format("hospital_ref_no")} as number, admission_date as ca, claim_amount::double as cm from c0),
b as (select distinct bill_id, hospital_id, {_TAIL.format("bill_id")} as number, admission_date as ba, net_payable::double as bm from bills where bill_id is not null),
routes as (select claim_id, bill_id, 'REFERENCE' as m, 0.98::double as s, round(abs(cm - bm), 2) as amount_diff, abs(date_diff('day', ca, ba)) as date_diff from c join b on c.hospital_id = b.hospital_id and c.number = b.number
  union all select claim_id, bill_id, 'ATTRIBUTE', coalesce(greatest(0.5, round(0.95 - 2 * round(abs(cm - bm), 2) / nullif(abs(bm), 0) - 0.10 * abs(date_diff('day', ca, ba)) / 2, 3)), 0.5)::double, round(abs(cm - bm), 2), abs(date_diff('day', ca, ba))
  from c join b on c.hospital_id = b.hospital_id and abs(date_diff('day', ca, ba)) <= 2 and abs(cm - bm) <= 0.02 * abs(bm)),
one as (select claim_id, bill_id, case when count(distinct m) > 1 then 0.99 else max(s) end as match_confidence, min(amount_diff) as amount_diff, min(date_diff) as date_diff, max(m) as match_method, count(distinct m) > 1 as is_corroborated from routes group by 1, 2),
k as (select *, row_number() over w as rn, lead(match_confidence) over w as nc, lead(amount_diff) over w as na, lead(date_diff) over w as nd, count(*) over (partition by claim_id) as n from one window w as (partition by claim_id order by match_confidence desc, amount_diff nulls last, date_diff nulls last, bill_id)),
top as (select *, n > 1 and nc is not distinct from match_confidence and na is not distinct from amount_diff and nd is not distinct from date_diff as even from k where rn = 1),
back as (select *, row_number() over (partition by bill_id order by match_confidence desc, amount_diff nulls last, date_diff nulls last, claim_id) as bn from top where not even)"""


def _linked(spark, folder) -> tuple[DataFrame, links.Linked]:
    c = table(spark, folder, "claims").select("claim_id", "hospital_id", "hospital_ref_no", "admission_date", "claim_amount", "export_date", "ingestion_ts").filter("claim_id is not null")
    c = written(first_by(c, ["claim_id"], [F.desc("export_date"), F.desc("ingestion_ts"), F.coalesce("hospital_ref_no", F.lit(""))]), "claims")
    return c, links.link(c, table(spark, folder, "bills").select("bill_id", "hospital_id", "admission_date", "net_payable").distinct())


@query(f"""with {_ROUTES} select 'accepted' as outcome, claim_id, bill_id, match_method, match_confidence, is_corroborated from back where bn = 1
union all select 'ambiguous', claim_id, bill_id, match_method, match_confidence, is_corroborated from top where even union all select 'contested', claim_id, bill_id, match_method, match_confidence, is_corroborated from back where bn > 1""")
def bill_links(spark, folder):
    """Claims and bills linked by reference and by attributes, and those that wait for review."""
    _, found = _linked(spark, folder)
    cols = ("claim_id", "bill_id", "match_method", "match_confidence", "is_corroborated")
    return found.accepted.select(F.lit("accepted").alias("outcome"), *cols).unionByName(found.review.select(F.col("reason").alias("outcome"), *cols))


@query(f"""with {_ROUTES}, n as (select (select count(*) from c) as n, (select count(*) from back where bn = 1) as a, (select count(*) from back where bn = 1 and is_corroborated) as c, (select count(*) from top where even) + (select count(*) from back where bn > 1) as r)
select 'link_rate' as check_name, round(a / n::double, 6) as value, a || ' of ' || n as detail from n union all select 'corroboration_rate', round(c / a::double, 6), c || ' of ' || a from n union all select 'review_rate', round(r / n::double, 6), r || ' of ' || n from n""")
def link_rates(spark, folder):
    """How many claims were linked, how many links two routes found, how many wait."""
    c, found = _linked(spark, folder)
    return measures.link_health(found.accepted, found.review, c)


# --- codes ----------------------------------------------------------------------------------------------------------

_NAMED = """
items as (select p_partkey, upper(p_name) as name, p_type as grp, case when p_partkey % 5 = 0 then p_brand end as code from part),
cat as (select distinct upper(p_name) as name, p_type as grp, p_brand as code from part where p_partkey % 3 <> 0),
ex as (select name, min(code) as code from cat group by 1),
todo as (select distinct name from items where code is null and name not in (select name from ex)),
near as (select t.name, c.code, min(levenshtein(t.name, c.name)) as d, min(levenshtein(t.name, c.name) / greatest(length(t.name), length(c.name))::double) as r from todo t join cat c on levenshtein(t.name, c.name) / greatest(length(t.name), length(c.name))::double <= 0.15 group by 1, 2),
best as (select * from (select *, row_number() over (partition by name order by d, code) as rn, lead(d) over (partition by name order by d, code) as nd from near) where rn = 1 and (nd is null or nd > d)),
modal as (select grp, code from (select grp, code, row_number() over (partition by grp order by count(*) desc, code) as rn from cat group by grp, code) where rn = 1),
coded as (select p_partkey, coalesce(i.code, e.code, b.code, m.code) as code, case when i.code is not null then 'SOURCE' when e.code is not null then 'EXACT_NAME' when b.code is not null then 'FUZZY_NAME' when m.code is not null then 'GROUP' else 'UNMAPPED' end as tier,
  case when i.code is not null then 1.0 when e.code is not null then 0.95 when b.code is not null then round(1 - b.r, 4) when m.code is not null then 0.4 else 0.0 end as confidence
  from items i left join ex e on i.name = e.name left join best b on i.name = b.name left join modal m on i.grp = m.grp)"""


def _procedures(spark, folder):
    """Parts as procedures whose names carry endings, in two versions of which the later counts, and a catalogue of parts."""
    p = table(spark, folder, "part")
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.concat("p_name", F.lit(" - Left"))).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" (Revision)")))
    rows = p.select(k.alias("procedure_code"), name.alias("procedure_name"), F.col("p_type").alias("specialty"), F.when(k % 5 == 0, F.col("p_brand")).alias("icd10_code"), F.lit(2).alias("ingestion_ts"), F.lit("b").alias("source_file"))
    old = rows.withColumns({"procedure_name": F.lit("old"), "icd10_code": F.lit("old"), "ingestion_ts": F.lit(1)})
    return procedures.coded(rows.unionByName(old), p.filter(k % 3 != 0).select(F.col("p_name").alias("procedure_name"), F.col("p_type").alias("specialty"), F.col("p_brand").alias("icd10_code")))


@query(f"with {_NAMED} select p_partkey, code as icd10_code, tier as icd10_source, confidence::double as icd10_confidence, left(code, 1) as icd10_chapter, tier <> 'SOURCE' as is_icd10_inferred, case when confidence >= 0.95 then 'High' when confidence >= 0.7 then 'Medium' when confidence > 0 then 'Low' else 'None' end as icd10_reliability from coded")
def dim_procedure(spark, folder):
    """Procedures with their code, its tier and how reliable it is."""
    return procedures.dim_procedure(_procedures(spark, folder)).select(F.col("procedure_code").alias("p_partkey"), "icd10_code", "icd10_source", "icd10_confidence", "icd10_chapter", "is_icd10_inferred", "icd10_reliability")


@query(f"""with {_NAMED}, n as (select count(*) as n, count(code) as c from coded) select 'code_fill' as check_name, round(c / n::double, 6) as value, c || ' of ' || n as detail from n
union all select 'code_' || lower(tier), round(count(*) / max(n)::double, 6), count(*) || ' of ' || max(n) from coded, n group by tier""")
def code_tiers(spark, folder):
    """Share of procedures with a code, and of each tier."""
    return measures.code_fill(_procedures(spark, folder))


@query("""with t as (select p_partkey, p_type, p_size from part), d as (select p_type, max(p_size) as top from part where p_type in ('LARGE', 'SMALL') group by 1) select p_partkey, coalesce(top, 0)::bigint as top from t left join d using (p_type)""")
def lookup_default(spark, folder):
    """Parts with what a table says of their type, or the default where it says nothing."""
    p = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    top = p.filter("p_type in ('LARGE', 'SMALL')").groupBy("p_type").agg(F.max("p_size").alias("top"))
    return rules.lookup_or(p, top, ["p_type"], {"top": F.lit(0)}).select("p_partkey", *big("top"))


# --- star -----------------------------------------------------------------------------------------------------------

_DAY = "2025-06-30"
_AGE = f"floor(date_diff('day', dob, date '{_DAY}') / 365.25)"


@query(f"""with m as (select * from (select *, row_number() over (partition by mpi_id order by dw_updated_at desc, concat_ws('|', name, phone, dob)) as rn from patient_master where mpi_id is not null) where rn = 1),
w as (select mpi_id, count(distinct patient_id) as n, string_agg(distinct hospital_id, ',' order by hospital_id) as hs, count(distinct hospital_id) as h from patient_crosswalk where mpi_id is not null group by 1)
select m.mpi_id, coalesce(n, 0) as registration_count, hs as hospitals, coalesce(h, 0) as hospital_count, {_AGE}::bigint as age_years,
  case when dob is null then 'Unknown' when {_AGE} < 1 then 'Infant' when {_AGE} < 13 then 'Child' when {_AGE} < 20 then 'Adolescent' when {_AGE} < 40 then 'Adult 20-39' when {_AGE} < 60 then 'Adult 40-59' when {_AGE} < 75 then 'Senior 60-74' else 'Elderly 75+' end as age_band, coalesce(h, 0) > 1 as is_multi_hospital
from m left join w on m.mpi_id = w.mpi_id""")
def dim_patient(spark, folder):
    """People with their registrations, hospitals, age and band."""
    m = table(spark, folder, "patient_master").filter("mpi_id is not null")
    m = first_by(m, ["mpi_id"], [F.desc("dw_updated_at"), F.concat_ws("|", "name", "phone", F.col("dob").cast("string"))])
    d = gold.dim_patient(m, table(spark, folder, "patient_crosswalk"), _DAY)
    return d.select("mpi_id", *big("registration_count"), F.array_join("hospitals", ",").alias("hospitals"), *big("hospital_count", "age_years"), "age_band", "is_multi_hospital")


_DOCTORS = f"""{_STANDING},
told as (select doctor_id, effective_from, holds_to, {", ".join(_SAME.format(c) + " as " + c for c in VERSIONED)} from held where holds_to >= effective_from),
marked as (select *, case when lag(holds_to) over w + interval 1 day = effective_from and {" and ".join(f"lag({c}) over w is not distinct from {c}" for c in VERSIONED)} then 0 else 1 end as fresh from told window w as (partition by doctor_id order by effective_from)),
numbered as (select *, sum(fresh) over (partition by doctor_id order by effective_from rows unbounded preceding) as version from marked),
docs as (select doctor_id, version, min(effective_from) as valid_from, max(holds_to) as valid_to, min(department) as department, min(specialty) as specialty, min(designation) as designation from numbered group by 1, 2)"""


@query(f"with {_DOCTORS} select doctor_id, version::bigint as version, department, designation, date_diff('day', valid_from, least(valid_to, date '{_DAY}')) as assignment_days, coalesce(designation in ('senior consultant', 'head of department'), false) as is_senior, valid_to = date '9999-12-31' as is_current from docs")
def dim_doctor(spark, folder):
    """Versions of doctors with the days each had held and whether it is a senior one."""
    d = gold.dim_doctor(doctor_history(table(spark, folder, "dim_doctor")).versions, _DAY)
    return d.select("doctor_id", *big("version"), "department", "designation", *big("assignment_days"), "is_senior", "is_current")


@query("select hospital_id, hospital_name, case when bed_capacity is null then 'Unknown' when bed_capacity >= 450 then 'Large' when bed_capacity >= 280 then 'Medium' else 'Small' end as size_band, (bed_capacity // 2 + bed_capacity // 10)::bigint as total_beds, round((bed_capacity // 10) / nullif(bed_capacity // 2 + bed_capacity // 10, 0)::double, 4) as critical_care_bed_pct from dim_hospital")
def dim_hospital(spark, folder):
    """Hospitals with their size, and the beds of two wards for each."""
    h = table(spark, folder, "dim_hospital")
    wards = h.select("hospital_id", F.inline(F.array(F.struct(F.lit("GENERAL").alias("ward_type"), F.floor(F.col("bed_capacity") / 2).alias("bed_count")), F.struct(F.lit("ICU").alias("ward_type"), F.floor(F.col("bed_capacity") / 10).alias("bed_count")))))
    return gold.dim_hospital(h, wards).select("hospital_id", "hospital_name", "size_band", *big("total_beds"), "critical_care_bed_pct")


@query("with i as (select distinct insurer_id from claims where insurer_id is not null), r as (select distinct insurer_id, hospital_id from claims where insurer_id is not null and hospital_id is not null) select insurer_id, count(hospital_id) as rule_count, round(avg(right(hospital_id, 2)::int / 100.0), 4)::double as avg_copay_pct, max(right(hospital_id, 2)::int * 10.0)::double as max_room_rent_cap from i left join r using (insurer_id) group by 1")
def dim_insurer(spark, folder):
    """Insurers with what their rules look like; a rule for each hospital that they have had a claim of."""
    c = table(spark, folder, "claims").filter("insurer_id is not null")
    n = F.substring("hospital_id", -2, 2).cast("int")
    r = c.filter("hospital_id is not null").select("insurer_id", "hospital_id").distinct().select("insurer_id", (n / 100.0).alias("copay_pct"), (n * 10.0).alias("room_rent_cap_per_day"))
    return gold.dim_insurer(c.select("insurer_id").distinct(), r).select("insurer_id", "rule_count", "avg_copay_pct", "max_room_rent_cap")


_VISITS = f"""{_DOCTORS},
v as (select * from (select *, row_number() over (partition by visit_id order by dw_updated_at desc) as rn from fact_patient_visit where visit_id is not null) where rn = 1),
s as (select v.visit_id, v.hospital_id, v.mpi_id, a.department as department_at_visit, n.department as department_current, a.designation as doctor_designation, coalesce(upper(trim(v.admission_type)) in ('IPD', 'EMERGENCY'), false) as inp,
  case when v.mpi_id is not null then date_diff('day', lag(v.discharge_date) over (partition by v.mpi_id order by v.admission_date nulls first, v.visit_id), v.admission_date) end as gap,
  case when v.mpi_id is not null and v.hospital_id is not null then date_diff('day', lag(v.discharge_date) over (partition by v.mpi_id, v.hospital_id order by v.admission_date nulls first, v.visit_id), v.admission_date) end as own
  from v left join docs a on v.doctor_id = a.doctor_id and v.admission_date between a.valid_from and a.valid_to left join docs n on v.doctor_id = n.doctor_id and n.valid_to = date '9999-12-31'),
visits as (select *, inp and coalesce(gap between 0 and 30, false) as net, inp and coalesce(own between 0 and 30, false) as hosp from s)"""


def _visits(spark, folder):
    v = table(spark, folder, "fact_patient_visit").filter("visit_id is not null").select("visit_id", "doctor_id", "hospital_id", "mpi_id", "admission_date", "discharge_date", "admission_type", "dw_updated_at")
    v = written(first_by(v, ["visit_id"], [F.desc("dw_updated_at")]).drop("dw_updated_at"), "visits")
    docs = written(doctor_history(table(spark, folder, "dim_doctor")).versions, "doctors")
    return gold.fact_patient_visit(v, docs)


@query(f"with {_VISITS} select visit_id, department_at_visit, department_current, doctor_designation, gap as days_since_prev_discharge, net as readmit_30d_network, hosp as readmit_30d_same_hospital, net and not hosp as readmit_cross_hospital_only from visits")
def fact_visits(spark, folder):
    """Visits with the doctor's department then and now and returns at two scopes."""
    return _visits(spark, folder).select("visit_id", "department_at_visit", "department_current", "doctor_designation", *big("days_since_prev_discharge"), "readmit_30d_network", "readmit_30d_same_hospital", "readmit_cross_hospital_only")


@query(f"""with {_VISITS}, c as (select count(*) as visits, count(distinct mpi_id) as people, sum(inp::int)::bigint as inpatient_visits, round(avg(case when inp then net::int end), 6) as rate_network, round(avg(case when inp then hosp::int end), 6) as rate_hospital, sum((net and not hosp)::int)::bigint as hidden from visits),
x as (select department_at_visit as d, count(*) as n from visits where department_at_visit is not null group by 1), y as (select department_current as d, count(*) as n from visits where department_current is not null group by 1),
z as (select sum(abs(coalesce(y.n, 0) - coalesce(x.n, 0)))::bigint as misattributed, sum(coalesce(x.n, 0))::bigint as attributed from x full join y on x.d = y.d)
select c.*, round((rate_network - rate_hospital) * 100, 4) as gap_pp, z.* from c, z""")
def headline_totals(spark, folder):
    """Visits, people, returns at two scopes and consultations that the present department would take: one pass over the facts."""
    v = written(_visits(spark, folder).select("mpi_id", "is_inpatient", "readmit_30d_network", "readmit_30d_same_hospital", "readmit_cross_hospital_only", "department_at_visit", "department_current"), "visits")
    inp = lambda c: F.when(F.col("is_inpatient"), F.col(c).cast("int"))
    one = v.agg(
        F.count(F.lit(1)).alias("visits"), F.count_distinct("mpi_id").alias("people"), F.sum(F.col("is_inpatient").cast("int")).alias("inpatient_visits"),
        F.round(F.avg(inp("readmit_30d_network")), 6).alias("rate_network"), F.round(F.avg(inp("readmit_30d_same_hospital")), 6).alias("rate_hospital"), F.sum(F.col("readmit_cross_hospital_only").cast("int")).alias("hidden"),
    )
    sides = F.array(F.struct(F.col("department_at_visit").alias("d"), F.lit(1).alias("a"), F.lit(0).alias("b")), F.struct(F.col("department_current").alias("d"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    gap = v.select(F.inline(sides)).filter("d is not null").groupBy("d").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).agg(F.sum(F.abs(F.col("b") - F.col("a"))).alias("misattributed"), F.sum("a").alias("attributed"))
    both = one.unionByName(gap, True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("gap_pp", F.round((F.col("rate_network") - F.col("rate_hospital")) * 100, 4))


@query("""with l as (select distinct transition_key, claim_id, status_date, submitted_date, insurer_id from claim_lifecycle where rebuilt_on = (select max(rebuilt_on) from claim_lifecycle)),
u as (select *, row_number() over (partition by transition_key order by submitted_date nulls first, insurer_id nulls first) as rn from l)
select transition_key, claim_id, strftime(status_date, '%Y%m%d')::bigint as status_date_sk, date_diff('day', submitted_date, status_date) as days_since_submission, insurer_id is not null as has_insurer_sk from u where rn = 1""")
def fact_claims(spark, folder):
    """Transitions of the last rebuild as facts."""
    l = table(spark, folder, "claim_lifecycle")
    l = l.join(F.broadcast(l.agg(F.max("rebuilt_on").alias("rebuilt_on"))), "rebuilt_on").select("transition_key", "claim_id", "status_date", "submitted_date", "insurer_id", "hospital_id", "patient_id").drop("hospital_id", "patient_id").distinct()
    f = gold.fact_claim_lifecycle(first_by(l, ["transition_key"], [F.asc("submitted_date"), F.asc("insurer_id")]).withColumn("hospital_id", F.lit(None).cast("string")))
    return f.select("transition_key", "claim_id", *big("status_date_sk", "days_since_submission"), F.col("insurer_sk").isNotNull().alias("has_insurer_sk"))


_WARDS = """
v as (select * from (select *, row_number() over (partition by visit_id order by dw_updated_at desc) as rn from fact_patient_visit where visit_id is not null) where rn = 1),
g as (select hospital_id, mpi_id, admission_date as a, coalesce(discharge_date, admission_date + 5)::date as b, discharge_date is null as is_open from v where is_inpatient and hospital_id is not null),
d as (select *, cast(a + i::int as date) as day from g, lateral (select unnest(generate_series(0, date_diff('day', a, b))) as i) where a <= b),
q as (select hospital_id, day, count(distinct mpi_id) as occupied_beds, sum(is_open::int)::bigint as open_stays, count(distinct case when day = a then mpi_id end) as admissions, count(distinct case when day = b and not is_open then mpi_id end) as discharges,
  round(sum(case when day = b then date_diff('day', a, b) + 1 end) / nullif(sum((day = b)::int), 0)::double, 2) as mean_stay from d group by 1, 2),
w as (select q.*, round(occupied_beds / nullif(bed_count, 0)::double, 4) as occupancy_rate, round(discharges / nullif(bed_count, 0)::double, 4) as turnover_rate, bed_count from q left join (select hospital_id, max(ceil(bed_capacity / 100.0))::bigint as bed_count from dim_hospital group by 1) using (hospital_id)),
f as (select *, coalesce(occupancy_rate > 1, false) as is_over_capacity, case when occupancy_rate is null then 'Unknown' when occupancy_rate >= 0.95 then 'Critical 95%+' when occupancy_rate >= 0.85 then 'High 85-95%' when occupancy_rate >= 0.6 then 'Normal 60-85%' else 'Low <60%' end as occupancy_band from w)"""


def _occupancy(spark, folder):
    """Hospitals as wards of a hundredth of their beds, inpatient visits as stays; those without a discharge are open for five days."""
    v = table(spark, folder, "fact_patient_visit").filter("visit_id is not null").select("visit_id", "hospital_id", "mpi_id", "admission_date", "discharge_date", "is_inpatient", "dw_updated_at")
    v = first_by(v, ["visit_id"], [F.desc("dw_updated_at")]).filter("is_inpatient and hospital_id is not null")
    s = v.select("hospital_id", "mpi_id", F.col("admission_date").alias("start_date"), F.coalesce("discharge_date", F.date_add("admission_date", 5)).alias("end_date"), F.col("discharge_date").isNull().alias("is_open"))
    beds = table(spark, folder, "dim_hospital").groupBy("hospital_id").agg(F.max(F.ceil(F.col("bed_capacity") / 100)).alias("bed_count"))
    return stays.fact_bed_occupancy(stays.ward_days(s, beds, ["hospital_id"], "mpi_id"), ["hospital_id"])


@query(f"with {_WARDS} select hospital_id, strftime(day, '%Y-%m-%d') as day, occupied_beds, open_stays, admissions, discharges, mean_stay, occupancy_rate, turnover_rate, is_over_capacity, occupancy_band from f")
def fact_occupancy(spark, folder):
    """Wards by day with occupancy, turnover and band."""
    return _occupancy(spark, folder).select("hospital_id", text_day("day"), "occupied_beds", "open_stays", "admissions", "discharges", "mean_stay", "occupancy_rate", "turnover_rate", F.coalesce("is_over_capacity", F.lit(False)).alias("is_over_capacity"), "occupancy_band")


@query(f"with {_WARDS} select hospital_name, date_trunc('month', day)::date::varchar as month, ((200 * sum(round(occupancy_rate * 10000)::bigint) + count(occupancy_rate)) // nullif(2 * count(occupancy_rate), 0))::bigint / 10000.0::double as occupancy_pct, sum(occupied_beds)::bigint as bed_days, max(bed_count) as beds from f join dim_hospital using (hospital_id) group by 1, 2")
def occupancy_months(spark, folder):
    """Mean occupancy by hospital and month, summed in whole ten-thousandths."""
    o = _occupancy(spark, folder).groupBy("hospital_id", F.trunc("day", "month").alias("month")).agg((F.expr("(200 * sum(cast(round(occupancy_rate * 10000) as bigint)) + count(occupancy_rate)) div nullif(2 * count(occupancy_rate), 0)") / 10000).alias("occupancy_pct"), F.sum("occupied_beds").alias("bed_days"), F.max("bed_count").alias("beds"))
    return o.join(table(spark, folder, "dim_hospital").select("hospital_id", "hospital_name"), "hospital_id").select("hospital_name", text_day("month"), "occupancy_pct", "bed_days", *big("beds"))


@query(f"""with {_WARDS}, h as (select *, round(mean_stay * 100)::bigint as cents from f), m as (select quantile_disc(cents, 0.5) as mid from h where cents is not null),
pq as (select hospital_id, 'FY' || (year(day) - (month(day) < 4)::int) as fy, ((month(day) + 8) % 12) // 3 + 1 as fq, count(*) as days, sum((occupancy_rate >= 0.85)::int)::bigint as days_above, ((2 * sum(cents) + count(cents)) // nullif(2 * count(cents), 0))::bigint as own from h group by 1, 2, 3)
select hospital_id, fy, fq, days, days_above, own / 100.0::double as ward_alos, mid / 100.0::double as median_alos, (own - mid) / 100.0::double as alos_vs_network from pq cross join m where days_above > 20""")
def pressure_quarters(spark, folder):
    """Wards above 85 % on more than 20 days of a fiscal quarter, with their mean stay against the median of all, in whole
    hundredths of a day so that no sum depends on the order of its terms."""
    o = written(_occupancy(spark, folder).select("hospital_id", "day", "occupancy_rate", F.round(F.col("mean_stay") * 100).cast("bigint").alias("cents")), "days")
    mid = F.lit(o.agg(F.percentile_approx("cents", 0.5, 1_000_000).alias("mid")).first()["mid"]).cast("bigint")
    month = F.month("day")
    q = o.groupBy("hospital_id", F.concat(F.lit("FY"), F.year("day") - F.when(month < 4, 1).otherwise(0)).alias("fy"), (F.floor(F.pmod(month + 8, F.lit(12)) / 3) + 1).alias("fq")).agg(F.count(F.lit(1)).alias("days"), F.sum(F.when(F.col("occupancy_rate") >= 0.85, 1).otherwise(0)).alias("days_above"), F.expr("(2 * sum(cents) + count(cents)) div nullif(2 * count(cents), 0)").alias("own"))
    return q.filter("days_above > 20").select("hospital_id", "fy", "fq", "days", "days_above", (F.col("own") / 100).alias("ward_alos"), (mid / 100).alias("median_alos"), ((F.col("own") - mid) / 100).alias("alos_vs_network"))
