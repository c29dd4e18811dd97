"""Queries for the library's operators over the star-schema tables, each with its SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import calendar
from ..functions.similarity import jaro_winkler
from ..functions.text import normalize_name, normalize_phone, reference_sequence, sha_key, title_pattern
from ..operators.entity import assign_stable_ids, block_pairs, exact_links, oversized, pair_quality, survivors, three_way, weighted_score
from ..operators.graph import components
from ..operators.history import close_open, type2_loads, type2_merge
from ..operators.inference import infer_codes
from ..operators.intervals import daily_state, open_on_days, segments
from ..operators.joins import band_join, point_in_time, wildcard_match
from ..operators.quality import Check, evaluate
from ..operators.references import orphans
from ..operators.states import closure, move_class
from ..operators.windows import first_by, most_frequent, repeat_within, resolve_unique, sequence_with_neighbours
from ..session import shared_folder, written
from ..sources.store import TableStore, checksum, merged
from .domain import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def big(*cols: str):
    return [F.col(c).cast("bigint").alias(c) for c in cols]


def text_day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


# --- orders in time -------------------------------------------------------------------------------------------------

_GAPS = """
with o as (select o_orderkey, o_custkey, o_orderpriority, cast(o_orderdate as date) as d, c_nationkey from orders join customer on o_custkey = c_custkey),
g as (select *, date_diff('day', lag(d) over (partition by o_custkey order by d, o_orderkey), d) as any_gap,
  date_diff('day', lag(d) over (partition by o_custkey, o_orderpriority order by d, o_orderkey), d) as own_gap from o)"""


@query(f"""{_GAPS}
select n_name, count(*) as n_orders, sum(case when any_gap between 0 and 30 then 1 else 0 end)::bigint as network_repeats, sum(case when own_gap between 0 and 30 then 1 else 0 end)::bigint as own_repeats,
  round(avg(case when any_gap between 0 and 30 then 1.0 else 0.0 end), 6) as network_rate, round(avg(case when own_gap between 0 and 30 then 1.0 else 0.0 end), 6) as own_rate
from g join nation on c_nationkey = n_nationkey group by n_name""")
def repeat_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Orders within 30 days of the customer's last one, over all priorities and within the same one, by nation."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = repeat_within(orders, ["o_custkey"], "d", "d", "o_orderkey").withColumnRenamed("is_repeat", "any").drop("gap_days")
    rows = repeat_within(rows, ["o_custkey", "o_orderpriority"], "d", "d", "o_orderkey").withColumnRenamed("is_repeat", "own")
    one = rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("any").cast("int")).alias("a"), F.sum(F.col("own").cast("int")).alias("o"))
    by = one.join(customers, "o_custkey").join(nations, "c_nationkey").groupBy("n_name").agg(F.sum("n").alias("n_orders"), F.sum("a").alias("network_repeats"), F.sum("o").alias("own_repeats"))
    rate = lambda c: F.round(F.col(c) / F.col("n_orders"), 6)
    return by.select("n_name", "n_orders", "network_repeats", "own_repeats", rate("network_repeats").alias("network_rate"), rate("own_repeats").alias("own_rate"))


@query("select o_custkey, o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1")
def latest_per_key(spark, folder):
    """Last order of each customer."""
    o = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return first_by(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).drop("o_orderdate")


@query("select user_id, event_type, strftime(ts, '%Y-%m-%d') as day, min(event_id) as event_id from (select *, row_number() over (partition by user_id, event_type, cast(ts as date) order by ts, event_id) as rn from events) where rn = 1 group by 1, 2, 3")
def first_observation(spark, folder):
    """First event of each user, type and day."""
    e = table(spark, folder, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "ts")
    return first_by(e, ["user_id", "event_type", "day"], [F.asc("ts"), F.asc("event_id")]).drop("ts")


_SEQ = """
with s as (select user_id, event_id, event_type, row_number() over w as seq, lag(event_type) over w as prev_state, lead(event_type) over w as next_state,
  date_diff('day', lag(cast(ts as date)) over w, cast(ts as date)) as days_in_prev
from events window w as (partition by user_id order by ts, event_id))"""
_MOVES = {"signup": ["view"], "view": ["click"], "click": ["purchase"], "purchase": ["view"], "error": []}
_REACH = {s: sorted(t) for s, t in closure(_MOVES).items()}


def _sequence(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type", F.col("ts"), F.to_date("ts").alias("day"))
    return sequence_with_neighbours(e, "user_id", ["ts", "event_id"], "event_type", "day", unique=True)


@query(f"{_SEQ} select user_id, event_id, seq, prev_state, next_state, days_in_prev from s")
def sequence_dwell(spark, folder):
    """Events numbered, with neighbours and days since the one before."""
    return _sequence(spark, folder).select("user_id", "event_id", *big("seq"), "prev_state", "next_state", *big("days_in_prev"))


def _in(table_):
    return " or ".join(f"(prev_state = '{s}' and event_type in ({', '.join(repr(x) for x in t)}))" for s, t in table_.items() if t)


@query(f"""{_SEQ} select prev_state, event_type, case when prev_state is null then 'INITIAL' when {_in(_MOVES)} then 'DIRECT' when {_in(_REACH)} then 'GAP' else 'ILLEGAL' end as move, count(*) as n from s group by 1, 2, 3""")
def transition_class(spark, folder):
    """Moves between event types counted by class."""
    s = _sequence(spark, folder).withColumn("move", move_class(F.col("prev_state"), F.col("event_type"), _MOVES))
    return s.groupBy("prev_state", "event_type", "move").agg(F.count(F.lit(1)).alias("n"))


# --- versions and points in time ------------------------------------------------------------------------------------

_VERSIONS = """
with s as (select o_custkey, cast(o_orderdate as date) as d, o_orderpriority as p from (select *, row_number() over (partition by o_custkey, cast(o_orderdate as date) order by o_orderkey desc) as rn from orders) where rn = 1),
m as (select *, case when lag(p) over (partition by o_custkey order by d) is not distinct from p then 0 else 1 end as fresh from s),
v as (select *, sum(fresh) over (partition by o_custkey order by d rows unbounded preceding) as version from m),
b as (select o_custkey, version, min(p) as p, min(d) as valid_from from v group by 1, 2),
h as (select o_custkey, version::bigint as version, p, valid_from, coalesce(lead(valid_from) over (partition by o_custkey order by valid_from) - interval 1 day, date '9999-12-31')::date as valid_to from b)"""


def _priority():
    return "o_custkey", "d", "until", {"p": F.col("o_orderpriority")}, ["o_orderkey"]


def _prioritised(spark, folder):
    return table(spark, folder, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), F.lit(None).cast("date").alias("until"), "o_orderpriority", "o_orderkey")


def _versions(spark, folder):
    return type2_merge(None, _prioritised(spark, folder), *_priority()).versions


@query(f"{_VERSIONS} select o_custkey, version, p, strftime(valid_from, '%Y-%m-%d') as valid_from, strftime(valid_to, '%Y-%m-%d') as valid_to, valid_to = date '9999-12-31' as is_current from h")
def scd2_versions(spark, folder):
    """History of each customer's order priority as versions."""
    return _versions(spark, folder).select("o_custkey", *big("version"), "p", text_day("valid_from"), text_day("valid_to"), "is_current")


@query(f"{_VERSIONS} select o_custkey, p, strftime(valid_from, '%Y-%m-%d') as valid_from from h where valid_to = date '9999-12-31'")
def scd2_current(spark, folder):
    """Open versions."""
    return _versions(spark, folder).filter("is_current").select("o_custkey", "p", text_day("valid_from"))


@query(f"{_VERSIONS} select o_custkey, p, strftime(valid_from, '%Y-%m-%d') as valid_from, strftime(valid_to, '%Y-%m-%d') as valid_to from h")
def scd2_incremental(spark, folder):
    """The same versions from two loads merged one after the other."""
    o = _prioritised(spark, folder)
    first = type2_merge(None, o.filter("d < '1998-01-01'"), *_priority()).stored()
    v = type2_merge(first, o.filter("d >= '1998-01-01'"), *_priority()).versions
    return v.select("o_custkey", "p", text_day("valid_from"), text_day("valid_to"))


@query(f"{_VERSIONS} select o_custkey, version, p, strftime(valid_from, '%Y-%m-%d') as valid_from, strftime(valid_to, '%Y-%m-%d') as valid_to from h")
def scd2_late(spark, folder):
    """The same versions from loads that arrive in no order of time: each holds rows of all years."""
    v = type2_loads(_prioritised(spark, folder), F.pmod(F.xxhash64("o_orderkey"), F.lit(3)), *_priority()).versions
    return v.select("o_custkey", *big("version"), "p", text_day("valid_from"), text_day("valid_to"))


@query(f"{_VERSIONS} select o_custkey, p, strftime(least(valid_to, case when valid_to = date '9999-12-31' and valid_from <= date '1998-06-30' then date '1998-06-30' else valid_to end), '%Y-%m-%d') as valid_to, valid_to = date '9999-12-31' and valid_from > date '1998-06-30' as is_current from h")
def scd2_closed(spark, folder):
    """Versions with those open at the middle of 1998 closed there."""
    return close_open(_versions(spark, folder), F.lit("1998-06-30").cast("date")).select("o_custkey", "p", text_day("valid_to"), "is_current")


_PIT = f"""{_VERSIONS},
f as (select o_custkey, cast(l_shipdate as date) as ship from lineitem join orders on l_orderkey = o_orderkey),
j as (select f.o_custkey, f.ship, t.p as p_then, n.p as p_now from f left join h t on f.o_custkey = t.o_custkey and f.ship between t.valid_from and t.valid_to left join h n on f.o_custkey = n.o_custkey and n.valid_to = date '9999-12-31')"""


def _pit(spark, folder):
    """Counts of lines by priority then and now. Versions and days are written once, as they are read several times."""
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    f = table(spark, folder, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("ship")).join(o, "l_orderkey").groupBy("o_custkey", "ship").agg(F.count(F.lit(1)).alias("n"))
    f = written(f, "ships")
    v = written(_versions(spark, folder).select("o_custkey", "valid_from", "valid_to", "is_current", "p"), "versions")
    then = point_in_time(f, v.withColumnRenamed("p", "p_then"), "o_custkey", "ship", ["p_then"])
    now = v.filter("is_current").select("o_custkey", F.col("p").alias("p_now"))
    return then.groupBy("o_custkey", "p_then").agg(F.sum("n").alias("n")).join(now, "o_custkey", "left").groupBy("p_then", "p_now").agg(F.sum("n").alias("n"))


@query(f"{_PIT} select p_then, p_now, count(*) as n from j group by 1, 2")
def pit_join(spark, folder):
    """Shipped lines by the customer's priority at the time and now."""
    return _pit(spark, folder)


@query(f"""{_PIT}, x as (select p_then as p, count(*) as n from j group by 1), y as (select p_now as p, count(*) as n from j group by 1)
select coalesce(x.p, y.p) as p, coalesce(x.n, 0) as n_then, coalesce(y.n, 0) as n_now, round((coalesce(y.n, 0) - coalesce(x.n, 0)) / nullif(x.n, 0)::double, 6) as share from x full join y on x.p is not distinct from y.p""")
def attribution_gap(spark, folder):
    """Lines by priority at the time against those by the present one."""
    # one aggregate by both, folded into each: no second run of the joins
    sides = F.array(F.struct(F.col("p_then").alias("p"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("b")), F.struct(F.col("p_now").alias("p"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b")))
    out = _pit(spark, folder).select(F.inline(sides)).groupBy("p").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return out.select("p", F.col("a").alias("n_then"), F.col("b").alias("n_now"), F.round((F.col("b") - F.col("a")) / F.nullif(F.col("a"), F.lit(0)), 6).alias("share"))


# --- rules, links, codes --------------------------------------------------------------------------------------------

_RULES = [
    ("R1", "A", "F", 1, 0.10, "1992-01-01", "9999-12-31"), ("R2", "A", "*", 2, 0.20, "1992-01-01", "1996-12-31"), ("R3", "*", "O", 3, 0.05, "1992-01-01", "9999-12-31"),
    ("R4", "*", "*", 9, 0.0, "1992-01-01", "9999-12-31"), ("R5", "R", "F", 1, 0.15, "1994-07-01", "1997-06-30"), ("R6", "R", "F", 1, 0.12, "1997-07-01", "9999-12-31"),
]
_RULES_SQL = "(values " + ", ".join(f"('{a}', '{b}', '{c}', {d}, {e}, date '{f}', date '{g}')" for a, b, c, d, e, f, g in _RULES) + ") as r(rule_id, l_returnflag, l_linestatus, priority, pct, effective_from, effective_to)"


@query(f"""select f.l_returnflag, f.l_linestatus, f.rule_id, count(*) as n, round(sum(pct), 2)::double as pct from (select l.*, r.rule_id, r.pct, row_number() over (partition by l.id order by r.priority, r.rule_id) as rn
from (select *, row_number() over () as id from lineitem) l join {_RULES_SQL} on (r.l_returnflag in (l.l_returnflag, '*')) and (r.l_linestatus in (l.l_linestatus, '*')) and cast(l.l_shipdate as date) between r.effective_from and r.effective_to) f where rn = 1 group by 1, 2, 3""")
def wildcard_rule(spark, folder):
    """Each line with the best rule of a table with wildcards and periods, joined to all lines by codes and day."""
    rules = spark.createDataFrame(_RULES, "rule_id string, l_returnflag string, l_linestatus string, priority int, pct double, effective_from string, effective_to string")
    rules = rules.withColumns({c: F.col(c).cast("date") for c in ("effective_from", "effective_to")})
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("ship"))
    best = wildcard_match(lines, rules, ["l_returnflag", "l_linestatus"], "l_orderkey", [F.asc("rule_priority")], day="ship", how="inner")
    return best.groupBy("l_returnflag", "l_linestatus", "rule_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("rule_pct"), 2).alias("pct"))


_BAND = """
with o as (select o_orderkey, o_custkey, cast(o_orderdate as date) as d, o_totalprice as t from orders),
p as (select a.o_orderkey as a, b.o_orderkey as b, abs(date_diff('day', a.d, b.d)) as days, abs(a.t - b.t) / b.t as off from o a join o b on a.o_custkey = b.o_custkey and a.o_orderkey < b.o_orderkey
  and abs(date_diff('day', a.d, b.d)) <= 20 and abs(a.t - b.t) <= 0.2 * abs(b.t))"""


def _band(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("t"))
    x, y = (o.select("o_custkey", *[F.col(c).alias(f"{c}{i}") for c in ("o_orderkey", "d", "t")]) for i in (1, 2))
    near = band_join(x, y, ["o_custkey"], {("d1", "d2"): 20}, {("t1", "t2"): 0.2}).filter("o_orderkey1 < o_orderkey2")
    return near.select(F.col("o_orderkey1").alias("a"), F.col("o_orderkey2").alias("b"), F.abs(F.datediff("d1", "d2")).cast("bigint").alias("days"), (F.abs(F.col("t1") - F.col("t2")) / F.col("t2")).alias("off"))


@query(f"{_BAND} select a, b, days from p")
def band_join_link(spark, folder):
    """Pairs of a customer's orders that are close in time and price."""
    return _band(spark, folder).drop("off")


@query(f"""{_BAND}, k as (select *, row_number() over (partition by a order by days, off, b) as rn, lead(days) over (partition by a order by days, off, b) as nd from p),
c as (select *, row_number() over (partition by b order by days, off, a) as back from k where rn = 1 and (nd is null or nd <> days))
select a, b, days from c where back = 1""")
def best_unique_match(spark, folder):
    """One partner at most for each order, without those between which the choice is open."""
    accepted, _ = resolve_unique(_band(spark, folder), "a", "b", [F.asc("days"), F.asc("off")], ["days"])
    return accepted.select("a", "b", "days")


@query("""select a.c_name, b.s_name from (select c_name, try_cast(nullif(regexp_extract(c_name, '([0-9]+)[^0-9]*$', 1), '') as bigint) as n from customer) a
join (select s_name, try_cast(nullif(regexp_extract(s_name, '([0-9]+)[^0-9]*$', 1), '') as bigint) as n from supplier) b on a.n = b.n""")
def reference_tail(spark, folder):
    """Names linked by their running number."""
    c = table(spark, folder, "customer").select("c_name", reference_sequence(F.col("c_name")).alias("n"))
    s = table(spark, folder, "supplier").select("s_name", reference_sequence(F.col("s_name")).alias("n"))
    return c.join(s, "n").select("c_name", "s_name")


@query(r"""with t as (select p_partkey, case p_partkey % 4 when 0 then 'Dr. ' || p_name when 1 then ' mr  MRS ' || p_name || ' 9' when 2 then p_name || '-x' end as raw, '+91 (' || p_partkey || ') 98765-43210' as phone from part),
n as (select *, trim(regexp_replace(regexp_replace(upper(trim(raw)), '[^A-Z ]', ' ', 'g'), ' +', ' ', 'g')) as a from t),
m as (select *, regexp_replace(a, '@TITLE@', '') as b from n)
select p_partkey, trim(regexp_replace(b, '@TITLE@', '')) as name, right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) as phone from m""".replace("@TITLE@", title_pattern()))
def name_normalise(spark, folder):
    """Names and phones in one form."""
    p = table(spark, folder, "part")
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("Dr. "), "p_name")).when(k == 1, F.concat(F.lit(" mr  MRS "), "p_name", F.lit(" 9"))).when(k == 2, F.concat("p_name", F.lit("-x")))
    return p.select("p_partkey", normalize_name(raw).alias("name"), normalize_phone(F.concat(F.lit("+91 ("), F.col("p_partkey").cast("string"), F.lit(") 98765-43210"))).alias("phone"))


@query("with c as (select c_custkey, c_name as a, nullif(c_mktsegment, 'BUILDING') as b, c_nationkey::varchar as c from customer) select c_custkey, sha256(coalesce(length(a) || ':' || a, '-') || coalesce(length(b) || ':' || b, '-') || coalesce(length(c) || ':' || c, '-')) as k from c")
def sha_keys(spark, folder):
    """Keys in which a null counts."""
    c = table(spark, folder, "customer")
    return c.select("c_custkey", sha_key([F.col("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")), F.col("c_nationkey")]).alias("k"))


_ITEMS = """
with items as (select p_partkey, case when p_partkey % 5 = 4 then null when p_partkey % 5 in (1, 3) then left(p_name, length(p_name) - 1) || case when p_partkey % 5 = 3 then 'QQQQQ' else '' end else p_name end as name, p_type as grp, case when p_partkey % 5 = 0 then p_brand end as code from part),
cat as (select p_name as name, p_type as grp, min(p_brand) as code from part where p_partkey % 3 <> 0 group by 1, 2),
ex as (select name, min(code) as code from cat group by 1),
todo as (select distinct name from items where code is null and name is not null and name not in (select name from ex)),
near as (select t.name, c.code, min(levenshtein(t.name, c.name)) as d, min(levenshtein(t.name, c.name) / greatest(length(t.name), length(c.name))::double) as r from todo t join cat c on levenshtein(t.name, c.name) / greatest(length(t.name), length(c.name))::double <= 0.15 group by 1, 2),
best as (select * from (select *, row_number() over (partition by name order by d, code) as rn, lead(d) over (partition by name order by d, code) as nd from near) where rn = 1 and (nd is null or nd > d)),
modal as (select grp, code from (select grp, code, row_number() over (partition by grp order by count(*) desc, code) as rn from cat group by grp, code) where rn = 1)"""


@query(f"""{_ITEMS} select i.p_partkey, coalesce(i.code, e.code, b.code, m.code) as inferred_code, case when i.code is not null then 'SOURCE' when e.code is not null then 'EXACT_NAME' when b.code is not null then 'FUZZY_NAME' when m.code is not null then 'GROUP' else 'UNMAPPED' end as tier
from items i left join ex e on i.name = e.name left join best b on i.name = b.name left join modal m on i.grp = m.grp""")
def tiered_code(spark, folder):
    """Missing brands of parts inferred by name and type."""
    p = table(spark, folder, "part")
    k = F.col("p_partkey") % 5
    cut_ = F.expr("left(p_name, length(p_name) - 1)")
    name = F.when(k == 1, cut_).when(k == 3, F.concat(cut_, F.lit("QQQQQ"))).when(k != 4, F.col("p_name"))
    items = p.select("p_partkey", name.alias("name"), F.col("p_type").alias("grp"), F.when(k == 0, F.col("p_brand")).alias("code"))
    cat = p.filter("p_partkey % 3 <> 0").groupBy(F.col("p_name").alias("name"), F.col("p_type").alias("grp")).agg(F.min("p_brand").alias("code"))
    return infer_codes(items, cat, "p_partkey", "name", "grp", "code").select("p_partkey", "inferred_code", "tier")


# --- entities -------------------------------------------------------------------------------------------------------

_BLOCKS = """
with k as (select c_custkey as r, 'acct' as s, (c_nationkey || '|' || floor(c_acctbal / 50)::bigint) as b from customer union all select c_custkey, 'seg', c_mktsegment || '|' || floor(c_acctbal / 10)::bigint from customer),
z as (select s, b, count(*) as n from k group by 1, 2)"""


def _blocked(spark, folder):
    c = table(spark, folder, "customer")
    step = lambda w: F.floor(F.col("c_acctbal") / w).cast("bigint").cast("string")
    return c, {"acct": F.concat_ws("|", F.col("c_nationkey").cast("string"), step(50)), "seg": F.concat_ws("|", "c_mktsegment", step(10))}


@query(f"{_BLOCKS} select x.r as a, y.r as b, string_agg(distinct x.s, ',' order by x.s) as strategies from k x join k y on x.s = y.s and x.b = y.b and x.r < y.r group by 1, 2")
def blocked_pairs(spark, folder):
    """Candidate pairs of customers from two strategies, in blocks of any size."""
    c, keys = _blocked(spark, folder)
    return block_pairs(c, "c_custkey", keys).withColumn("strategies", F.array_join("strategies", ","))


@query(f"{_BLOCKS} select s as strategy, b as block_key, n from z where n > 2")
def large_blocks(spark, folder):
    """Blocks of more than two customers."""
    c, keys = _blocked(spark, folder)
    return oversized(c, "c_custkey", keys, 2)


_NAMES = "with n as (select distinct p_name, left(p_name, 2) as k from part)"


@query(f"""{_NAMES}, p as (select a.p_name as a, b.p_name as b, jaro_winkler_similarity(a.p_name, b.p_name) as jw, case when length(a.p_name) % 2 = 0 then case when right(a.p_name, 3) = right(b.p_name, 3) then 1.0 else 0.0 end end as tail from n a join n b on a.k = b.k and a.p_name < b.p_name),
s as (select a, b, round((jw * 0.7 + coalesce(tail, 0) * 0.3) / (0.7 + case when tail is null then 0 else 0.3 end), 4) as score from p)
select a, b, score, case when score >= 0.9 then 'match' when score >= 0.75 then 'review' else 'none' end as outcome from s""")
def pair_score(spark, folder):
    """Pairs of part names scored by similarity and, where known, their ends."""
    n = table(spark, folder, "part").select("p_name", F.substring("p_name", 1, 2).alias("k")).distinct()
    x, y = n.withColumnRenamed("p_name", "a"), n.withColumnRenamed("p_name", "b")
    tail = F.when(F.length("a") % 2 == 0, F.when(F.expr("right(a, 3) = right(b, 3)"), 1.0).otherwise(0.0))
    p = x.join(y, "k").filter("a < b").select("a", "b", jaro_winkler("a", "b").alias("jw"), tail.alias("tail"))
    return p.select("a", "b", weighted_score({"jw": F.col("jw"), "tail": F.col("tail")}, {"jw": 0.7, "tail": 0.3}).alias("score")).withColumn("outcome", three_way(F.col("score"), 0.9, 0.75))


_EDGES = "e as (select distinct a.l_suppkey as a, b.l_suppkey as b from lineitem a join lineitem b on a.l_partkey = b.l_partkey and a.l_shipdate = b.l_shipdate and a.l_linenumber = b.l_linenumber and a.l_suppkey <> b.l_suppkey)"


def _supplier_groups(spark, folder):
    l = table(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_linenumber", "l_suppkey").distinct()
    key = l.select("l_suppkey", F.concat_ws("|", "l_partkey", F.col("l_shipdate").cast("string"), "l_linenumber").alias("k"))
    return components(exact_links(key, "l_suppkey", "k"), "a", "b")


_COMP = f"with recursive {_EDGES}, r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a), g as (select a as node, least(a, min(b)) as label from r group by a)"


@query(f"{_COMP} select node, label from g")
def components_of_links(spark, folder):
    """Suppliers that are linked over equal parts, days and lines."""
    return _supplier_groups(spark, folder)


@query("with k as (select distinct p_partkey, p_name || p_brand as k from part), f as (select k, min(p_partkey) as a from k group by 1) select a, p_partkey as b from k join f using (k) where a < p_partkey")
def exact_key_links(spark, folder):
    """Parts of equal name and brand linked to the least of them."""
    return exact_links(table(spark, folder, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("k")), "p_partkey", "k")


@query("""with r as (select distinct p_partkey, p_name, p_brand from part), c(x, a, b, ab) as (select 1, (select sum(n * (n - 1) / 2) from (select count(*) as n from r group by p_name)), (select sum(n * (n - 1) / 2) from (select count(*) as n from r group by p_brand)), (select sum(n * (n - 1) / 2) from (select count(*) as n from r group by p_name, p_brand)))
select a::double as n_predicted, b::double as n_actual, ab::double as n_both, round(ab / a::double, 6) as precision, round(ab / b::double, 6) as recall, round(2 * (ab / a::double) * (ab / b::double) / (ab / a::double + ab / b::double), 6) as f1 from c""")
def pairwise_quality(spark, folder):
    """Precision and recall of the grouping by name against that by brand."""
    return pair_quality(table(spark, folder, "part"), "p_partkey", "p_name", "p_brand")


@query("""select o_custkey, o_orderkey, n as n_records, k as n_sources, s as source_set from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn, count(*) over (partition by o_custkey) as n from orders)
join (select o_custkey, count(distinct o_orderpriority) as k, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as s from orders group by 1) using (o_custkey) where rn = 1""")
def survivor(spark, folder):
    """Newest order of each customer with the number and set of its priorities."""
    o = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    s = survivors(o, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], "o_orderpriority")
    return s.select("o_custkey", "o_orderkey", "n_records", *big("n_sources"), F.array_join("source_set", ",").alias("source_set"))


@query(f"{_COMP}, n as (select label, count(*) as n from g group by 1) select node, label, true as kept, true as is_new_above from g")
def registry_ids(spark, folder):
    """Ids of suppliers' groups over two runs: old ones stay, new ones are numbered above them."""
    g = written(_supplier_groups(spark, folder).select(F.col("node").cast("string").alias("node"), "label"), "groups")
    first = written(assign_stable_ids(g.filter("label % 2 = 0"), None), "ids")
    second = assign_stable_ids(g, first.select("node", "entity_id"))
    top = first.agg(F.coalesce(F.max("entity_id"), F.lit(0))).first()[0]
    both = second.join(first.select("node", F.col("entity_id").alias("old")), "node", "left")
    return both.select(F.col("node").cast("bigint").alias("node"), "label", F.coalesce(F.col("entity_id") == F.col("old"), F.lit(True)).alias("kept"), (F.col("old").isNotNull() | (F.col("entity_id") > top)).alias("is_new_above"))


def _sound(c: str) -> str:
    """Soundex in SQL: letters to digits, H and W vanish after the first letter, runs of a digit shrink, vowels vanish."""
    digits = f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    rest = f"left({digits}, 1) || replace(substr({digits}, 2), '7', '')"
    for d in "0123456":
        rest = f"regexp_replace({rest}, '{d}+', '{d}', 'g')"
    return f"case when {c} <> '' then rpad(left(left({c}, 1) || replace(substr({rest}, 2), '0', ''), 4), 4, '0') end"


def _norm(c: str) -> str:
    letters = f"trim(regexp_replace(regexp_replace(upper(trim({c})), '[^A-Z ]', ' ', 'g'), ' +', ' ', 'g'))"
    return f"trim(regexp_replace(regexp_replace({letters}, '{title_pattern()}', ''), '{title_pattern()}', ''))"


@query(f"""with p as (select mpi_id, dob, lower(trim(city)) as city, {_norm("name")} as n from patient_master where mpi_id is not null), w as (select *, split_part(n, ' ', 1) as f, case when n like '% %' then split_part(n, ' ', -1) end as l from p),
s as (select mpi_id, dob, city, {_sound("f")} as s1, {_sound("l")} as s2 from w),
k as (select mpi_id as r, 'date' as s, s1 || '|' || dob::varchar as b from s union select mpi_id, 'year', s1 || '|' || s2 || '|' || year(dob)::varchar from s union select mpi_id, 'city', s1 || '|' || s2 || '|' || city from s where city <> '')
select x.r as a, y.r as b, string_agg(distinct x.s, ',' order by x.s) as strategies from k x join k y on x.s = y.s and x.b = y.b and x.r < y.r group by 1, 2""")
def soundex_blocks(spark, folder):
    """Candidate pairs of patients by the sound of first and last name with birth date, birth year or city."""
    p = table(spark, folder, "patient_master").select("mpi_id", "dob", F.lower(F.trim("city")).alias("city"), F.split(normalize_name(F.col("name")), " ").alias("w"))
    first, last = F.soundex(F.get("w", F.lit(0))), F.when(F.size("w") > 1, F.soundex(F.element_at("w", -1)))
    both = lambda *c: F.when(F.greatest(*[x.isNull() | (x == "") for x in c]) == F.lit(False), F.concat_ws("|", *c))
    keys = {"date": both(first, F.col("dob").cast("string")), "year": both(first, last, F.year("dob").cast("string")), "city": both(first, last, F.col("city"))}
    return block_pairs(p, "mpi_id", keys).withColumn("strategies", F.array_join("strategies", ","))


# --- intervals ------------------------------------------------------------------------------------------------------

_SEG = """
with s as (select user_id, event_id, event_type, cast(ts as date) as start_date, lead(ts) over (partition by user_id order by ts, event_id) as nx from events),
g as (select user_id, event_id, event_type, start_date, greatest(start_date, coalesce(cast(nx as date), least(cast(start_date + interval 45 day as date), date '2024-02-10'))) as end_date, nx is null as is_open from s where event_type in ('view', 'click'))"""


def _segments(spark, folder):
    e = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return segments(e, "user_id", "ts", "event_id", "event_type", ["view", "click"], "2024-02-10")


@query(f"{_SEG} select event_id, user_id, strftime(start_date, '%Y-%m-%d') as start_date, strftime(end_date, '%Y-%m-%d') as end_date, is_open from g")
def event_segments(spark, folder):
    """Segments from views and clicks to the user's next event."""
    return _segments(spark, folder).select("event_id", "user_id", text_day("start_date"), text_day("end_date"), "is_open")


@query("""with s as (select o_orderkey, cast(o_orderdate as date) as a, cast(max(l_shipdate) as date) as b from orders join lineitem on l_orderkey = o_orderkey group by 1, 2)
select strftime(a + to_days(i::int), '%Y-%m-%d') as day, count(*) as n_open from s, lateral (select unnest(generate_series(0, date_diff('day', a, b))) as i) where a <= b group by 1""")
def open_by_day(spark, folder):
    """Orders open on each day, from order to last shipment."""
    last = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.max("l_shipdate")).alias("b"))
    o = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a")).join(last, "o_orderkey")
    return open_on_days(o, "a", "b").select(text_day("day"), "n_open")


_DAILY = f"""{_SEG},
d as (select event_type, user_id, cast(start_date + to_days(i::int) as date) as day, is_open, start_date, end_date from g, lateral (select unnest(generate_series(0, date_diff('day', start_date, end_date))) as i)),
q as (select event_type, day, count(distinct user_id) as present, sum(is_open::int)::bigint as open_segments, sum((day = start_date)::int)::bigint as starts, sum((day = end_date and not is_open)::int)::bigint as ends,
  round(sum(case when day = end_date and not is_open then date_diff('day', start_date, end_date) + 1 else 0 end) / nullif(sum((day = end_date and not is_open)::int), 0)::double, 4) as mean_days from d group by 1, 2)"""


@query(f"{_DAILY} select event_type, strftime(day, '%Y-%m-%d') as day, present, open_segments, starts, ends, mean_days from q")
def daily_states(spark, folder):
    """Users present by type and day, with openings and closings."""
    return daily_state(_segments(spark, folder), "event_type", "user_id").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""{_DAILY}, m as (select quantile_disc(present, 0.5) as mid from q), p as (select event_type, count(*) as n_days, sum((present > (select mid from m))::int)::bigint as n_above from q group by 1)
select event_type, n_days, n_above, mid::bigint as mid from p cross join m where n_above > 2""")
def pressure_days(spark, folder):
    """Types that are above the median day often."""
    d = written(daily_state(_segments(spark, folder), "event_type", "user_id"), "daily")
    mid = F.lit(d.agg(F.percentile_approx("present", 0.5, 100000).alias("mid")).first()["mid"]).cast("bigint")
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_days"), F.sum((F.col("present") > mid).cast("int")).alias("n_above")).withColumn("mid", mid).filter("n_above > 2")


@query("""with d as (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) as day)
select strftime(day, '%Y%m%d')::bigint as date_sk, year(day) as year, quarter(day) as quarter, month(day) as month, dayofyear(day) as day_of_year, week(day) as week, dayname(day) as day_name, monthname(day) as month_name, strftime(last_day(day), '%Y-%m-%d') as month_end,
 'FY' || (year(day) - (month(day) < 4)::int) || '-' || lpad((((year(day) - (month(day) < 4)::int) + 1) % 100)::varchar, 2, '0') as fiscal_year, ((month(day) + 8) % 12) // 3 + 1 as fiscal_quarter, (month(day) + 8) % 12 + 1 as fiscal_month, dayofweek(day) in (0, 6) as is_weekend, month(day) between 6 and 9 as is_monsoon from d""")
def date_dim(spark, folder):
    """Calendar with fiscal years from April."""
    c = calendar(spark, "1995-01-01", "2001-12-31")
    return c.select(*big("date_sk", "year", "quarter", "month", "day_of_year", "week"), "day_name", "month_name", text_day("month_end"), "fiscal_year", *big("fiscal_quarter", "fiscal_month"), "is_weekend", "is_monsoon")


# --- aggregates -----------------------------------------------------------------------------------------------------


@query("select l_suppkey, l_returnflag, n from (select l_suppkey, l_returnflag, count(*) as n, row_number() over (partition by l_suppkey order by count(*) desc, l_returnflag) as rn from lineitem group by 1, 2) where rn = 1")
def modal_value(spark, folder):
    """Most frequent flag of each supplier."""
    return most_frequent(table(spark, folder, "lineitem"), ["l_suppkey"], "l_returnflag")


@query("""select p_type, count(*) as n, quantile_disc(d, 0.5)::bigint as p50, quantile_disc(d, 0.9)::bigint as p90 from (select p_type, date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as d from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)
group by 1 having count(*) >= 50 order by n desc, p_type limit 10""")
def percentile_journey(spark, folder):
    """Days from order to shipment by type, the ten most frequent."""
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    p = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    d = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate").join(o, "l_orderkey").join(p, "l_partkey").withColumn("d", F.datediff("l_shipdate", "o_orderdate"))
    q = lambda x: F.percentile_approx("d", x, 100000).cast("bigint")
    return d.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), q(0.5).alias("p50"), q(0.9).alias("p90")).filter("n >= 50").orderBy(F.desc("n"), "p_type").limit(10)


@query(f"{_SEQ} select prev_state, count(*) as n, median(days_in_prev)::double as median_days, round(avg(days_in_prev), 6) as mean_days from s where prev_state is not null group by 1")
def median_dwell(spark, folder):
    """Days spent in each state. The exact median is taken over counted values, not over rows."""
    s = _sequence(spark, folder).filter("prev_state is not null").groupBy("prev_state", "days_in_prev").agg(F.count(F.lit(1)).alias("n"))
    return s.groupBy("prev_state").agg(F.sum("n").alias("n"), F.expr("percentile(days_in_prev, 0.5, n)").alias("median_days"), F.round(F.sum(F.col("days_in_prev") * F.col("n")) / F.sum("n"), 6).alias("mean_days"))


@query("""with o as (select o_custkey, max((o_orderstatus = 'F')::int) as ever_f, max((o_orderpriority = '1-URGENT')::int) as ever_urgent, count(*) as n from orders group by 1)
select c_mktsegment, count(*) as n_customers, sum(ever_f)::bigint as n_f, sum(ever_urgent)::bigint as n_urgent, quantile_disc(n, 0.5)::bigint as p50, min(case when ever_urgent = 1 then n end) as least from o join customer on o_custkey = c_custkey group by 1""")
def two_level(spark, folder):
    """Customers' ever-flags by segment: an aggregate of aggregates."""
    o = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max((F.col("o_orderstatus") == "F").cast("int")).alias("f"), F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("u"), F.count(F.lit(1)).alias("n"))
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, "c_custkey").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"), F.sum("f").alias("n_f"), F.sum("u").alias("n_urgent"), F.percentile_approx("n", 0.5, 100000).alias("p50"), F.min(F.when(F.col("u") == 1, F.col("n"))).alias("least"))


@query("""select p_brand, count(*) as n, count(distinct s_nationkey) as n_nations, count(distinct l_suppkey) as n_suppliers, case when count(distinct s_nationkey) >= 20 then 'systemic' when count(distinct s_nationkey) >= 5 then 'regional' else 'local' end as spread
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey where l_returnflag = 'R' group by 1""")
def systemic_reason(spark, folder):
    """Returned lines by brand: how many nations they come from."""
    p = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    l = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    g = l.join(p, "l_partkey").groupBy("p_brand", "l_suppkey").agg(F.sum("n").alias("n")).join(s, "l_suppkey").groupBy("p_brand").agg(F.sum("n").alias("n"), F.count_distinct("s_nationkey").alias("n_nations"), F.count("l_suppkey").alias("n_suppliers"))
    return g.withColumn("spread", F.when(F.col("n_nations") >= 20, "systemic").when(F.col("n_nations") >= 5, "regional").otherwise("local"))


@query("select c_custkey, c_name, round(c_acctbal, 2) as c_acctbal from customer order by c_acctbal desc, c_custkey limit 20")
def topk_tiebreak(spark, folder):
    """Twenty greatest balances, in a total order."""
    return table(spark, folder, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"))


@query("""select seq, label, n from (select 1 as seq, 'lines' as label, count(*) as n from lineitem union all select 2, 'returned', -count(*) from lineitem where l_returnflag = 'R' union all select 3, 'open', -count(*) from lineitem where l_linestatus = 'O' and l_returnflag <> 'R' union all select 4, 'rest', count(*) from lineitem where l_returnflag <> 'R' and l_linestatus <> 'O')""")
def waterfall(spark, folder):
    """Steps from all lines to the rest, in one pass."""
    l = table(spark, folder, "lineitem")
    r, o = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    n = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    one = l.agg(F.count(F.lit(1)).alias("lines"), n(r).alias("returned"), n(o & ~r).alias("open"), n(~r & ~o).alias("rest"))
    steps = [(1, "lines", 1), (2, "returned", -1), (3, "open", -1), (4, "rest", 1)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(s).alias("label"), (F.col(s) * sign).alias("n")) for i, s, sign in steps])))


# --- references, checks, merges --------------------------------------------------------------------------------------


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F')")
def customers_without_orders(spark, folder):
    """Customers without an urgent order that is finished: keys without a partner."""
    o = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


_REFS = "r as (select o_orderkey, case when o_orderkey % 7 = 0 then null else o_custkey + case when o_orderkey % 11 = 0 then 1000000 else 0 end end as a, case when o_orderkey % 5 = 0 then null else c_nationkey + case when o_orderkey % 13 = 0 then 100 else 0 end end as b from orders join customer on o_custkey = c_custkey)"


@query(f"""with {_REFS} select 'simple' as semantics, o_orderkey from r where a is not null and b is not null and not exists (select 1 from customer where c_custkey = a and c_nationkey = b)
union all select 'partial', o_orderkey from r where (a is not null or b is not null) and not exists (select 1 from customer where (a is null or c_custkey = a) and (b is null or c_nationkey = b))
union all select 'full', o_orderkey from r where (a is null) <> (b is null) or (a is not null and b is not null and not exists (select 1 from customer where c_custkey = a and c_nationkey = b))""")
def orphan_semantics(spark, folder):
    """Composite references with nulls under the three kinds of match."""
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    o = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(c, "c_custkey")
    r = o.select("o_orderkey", F.when(k % 7 != 0, F.col("c_custkey") + F.when(k % 11 == 0, 1000000).otherwise(0)).alias("a"), F.when(k % 5 != 0, F.col("c_nationkey") + F.when(k % 13 == 0, 100).otherwise(0)).alias("b"))
    parts = [orphans(r, c, ["a", "b"], ["c_custkey", "c_nationkey"], m).select(F.lit(m).alias("semantics"), "o_orderkey") for m in ("simple", "partial", "full")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CHECKS = [
    Check("orders_rows", "orders", "row_count", threshold=1),
    Check("orders_key", "orders", "unique", ("o_orderkey",), blocking=True),
    Check("lines_key", "lineitem", "unique", ("l_orderkey", "l_linenumber")),
    Check("events_props", "events", "not_null", ("props",)),
    Check("balance", "customer", "range", ("c_acctbal",), low=0, threshold=0.9),
    Check("discount", "lineitem", "range", ("l_discount",), low=0, high=0.1),
    Check("late", "lineitem", "expression", predicate="l_tax < 0.05", threshold=0.5),
    Check("heavy_tax", "lineitem", "expression", predicate="l_tax >= 0.05", threshold=0.4, compare="lte"),
    Check("line_count", "lineitem", "row_count", threshold=0, compare="gt"),
    Check("free_lines", "lineitem", "expression", predicate="l_discount = 0", threshold=0.5, compare="lt"),
    Check("exact_share", "orders", "unique", ("o_orderkey",), threshold=1.0, compare="eq"),
    Check("reported_only", "lineitem", "expression", predicate="l_quantity > 25", threshold=None),
    Check("customer_of_order", "orders", "referential", ("o_custkey",), target=("customer", "c_custkey")),
]


@query("""with v as (
select 'orders_rows' as check_name, count(*)::double as value, 1.0 as threshold from orders union all
select 'orders_key', count(distinct o_orderkey) / count(*)::double, 1.0 from orders union all
select 'lines_key', (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) / count(*)::double, 1.0 from lineitem union all
select 'events_props', count(props) / count(*)::double, 1.0 from events union all
select 'balance', 1 - avg((c_acctbal < 0)::int), 0.9 from customer union all
select 'discount', 1 - avg((l_discount < 0 or l_discount > 0.1)::int), 1.0 from lineitem union all
select 'late', avg((l_tax < 0.05)::int), 0.5 from lineitem union all
select 'customer_of_order', 1 - avg((o_custkey not in (select c_custkey from customer))::int), 1.0 from orders)
select check_name, round(value, 6) as value, value >= threshold as passed from v union all
select 'heavy_tax', round(avg((l_tax >= 0.05)::int), 6), avg((l_tax >= 0.05)::int) <= 0.4 from lineitem union all
select 'line_count', count(*)::double, count(*) > 0 from lineitem union all
select 'free_lines', round(avg((l_discount = 0)::int), 6), avg((l_discount = 0)::int) < 0.5 from lineitem union all
select 'exact_share', round(count(distinct o_orderkey) / count(*)::double, 6), count(distinct o_orderkey) = count(*) from orders union all
select 'reported_only', round(avg((l_quantity > 25)::int), 6), true from lineitem""")
def dq_scorecard(spark, folder):
    """Checks over the tables."""
    return evaluate(spark, lambda n: table(spark, folder, n), _CHECKS).select("check_name", "value", "passed")


def _store(spark) -> TableStore:
    import uuid

    return TableStore(spark, os.path.join(shared_folder(spark), f"store-{uuid.uuid4().hex}"))


_WHOLE = "a as (select o_orderkey, o_orderstatus, o_totalprice from orders), b as (select o_orderkey, 'X' as o_orderstatus, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 2 = 0 union all select -o_orderkey, 'N', o_totalprice from orders where o_orderkey % 2 <> 0)"


def _merged(spark, folder, how):
    """All orders merged with a source that has a changed or a new key from each of them."""
    a = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k, even = F.col("o_orderkey"), F.col("o_orderkey") % 2 == 0
    b = a.select(F.when(even, k).otherwise(-k).alias("o_orderkey"), F.when(even, "X").otherwise("N").alias("o_orderstatus"), (F.col("o_totalprice") + even.cast("int")).alias("o_totalprice"))
    store = _store(spark)
    store.overwrite("orders", a)
    how(store, b)
    return store.read("orders")


@query(f"with {_WHOLE} select * from b union all select * from a where o_orderkey not in (select o_orderkey from b)")
def merge_upsert(spark, folder):
    """Update and insert by key, from all orders."""
    return _merged(spark, folder, lambda s, b: s.upsert("orders", b, ["o_orderkey"]))


@query(f"with {_WHOLE} select * from a union all select * from b where o_orderkey not in (select o_orderkey from a)")
def merge_insert_only(spark, folder):
    """Insert of new keys, twice with the same result, from all orders."""
    return _merged(spark, folder, lambda s, b: [s.insert_new("orders", b, ["o_orderkey"]) for _ in range(2)])


@query(f"with {_WHOLE} select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null or (b.o_orderkey is not null and a.o_orderstatus = 'F') then b.o_orderstatus else a.o_orderstatus end as o_orderstatus, coalesce(a.o_totalprice, b.o_totalprice) as o_totalprice from a full join b on a.o_orderkey = b.o_orderkey")
def merge_conditional(spark, folder):
    """Update of one column where a condition holds, and insert, from all orders."""
    return _merged(spark, folder, lambda s, b: s.merge("orders", b, ["o_orderkey"], ["o_orderstatus"], lambda t, _: t("t.o_orderstatus") == "F"))


_CHANGED = """select o_orderkey, case when o_orderstatus = 'F' then 'G' else o_orderstatus end as o_orderstatus, o_totalprice + case when o_orderstatus = 'F' then 1 else 0 end as o_totalprice from orders"""


def _by_status(spark, folder):
    """A store with all orders in a partition for each status, and the rows that take the place of one of them."""
    a = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store = _store(spark)
    store.overwrite("orders", a.repartition(4, "o_orderkey"), partition_by=["o_orderstatus"])
    again = a.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("G").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return store, again


@query(f"{_CHANGED}")
def replace_where(spark, folder):
    """All orders of one status replaced by changed ones: the files of the others are not written."""
    store, again = _by_status(spark, folder)
    store.replace_where("orders", again, F.col("o_orderstatus") == "F")
    return store.read("orders")


@query("select 1::bigint as versions_kept_by_others, true as others_untouched, true as time_travel, true as vacuumed")
def replaced_files(spark, folder):
    """That a replacement keeps the files of other partitions, that the version before can be read, and that a vacuum deletes it."""
    store, again = _by_status(spark, folder)
    files = lambda: {r["f"] for r in store.read("orders").filter("o_orderstatus not in ('F', 'G')").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}  # noqa: E731  a few files
    before, n = files(), store.read("orders").filter("o_orderstatus = 'F'").count()
    store.replace_where("orders", again, F.col("o_orderstatus") == "F")
    old = store.read("orders", 1).filter("o_orderstatus = 'F'").count()
    same, gone = files() == before, store.vacuum("orders", 1)
    return spark.createDataFrame([(len(gone), same, old == n, store.versions("orders") == [2])], "versions_kept_by_others bigint, others_untouched boolean, time_travel boolean, vacuumed boolean")


@query("select year(o_orderdate) as y, count(*) as n, sum(o_orderkey)::bigint as keys from orders group by 1")
def appended(spark, folder):
    """Orders appended in four loads, each as files of its own, then read whole."""
    o = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("y"))
    store = _store(spark)
    for part in ("y < 1997", "y = 1997", "y = 1998", "y > 1998 or y is null"):
        store.append("orders", o.filter(part))
    return store.read("orders").groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("select o_orderstatus, count(*) as n from orders where o_orderstatus <> 'P' group by 1")
def time_travel(spark, folder):
    """The version of a table before rows were added to it."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    store = _store(spark)
    first = store.overwrite("orders", o.filter("o_orderstatus <> 'P'"))
    store.append("orders", o.filter("o_orderstatus = 'P'"))
    return store.read("orders", first).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) as n, true as same_again, true as order_free from orders")
def table_checksum(spark, folder):
    """Rows and whether the checksum is the same again and for other partitions."""
    o = table(spark, folder, "orders")
    one, two, three = (checksum(x, o.columns) for x in (o, o, o.repartition(5, "o_custkey")))
    return spark.createDataFrame([(int(one.split(":")[0]), one == two, one == three)], "n bigint, same_again boolean, order_free boolean")


@query("select n_nationkey::varchar as n_nationkey, n_name, n_regionkey::varchar as n_regionkey, '2024-01-05' as ingest_date from nation")
def raw_roundtrip(spark, folder):
    """A table written as CSV, ingested twice under a contract, and read from the archive."""
    from ..sources.contracts import Contract
    from ..sources.ingest import ingest
    from ..sources.registry import Registry

    store = _store(spark)
    n = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    landing = f"{store.root}/landing/nation"
    n.coalesce(1).write.option("header", True).csv(f"{landing}/2024-01-05")
    contract = Contract("nation", "csv", (("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")), ("n_nationkey",))
    registry = Registry(store)
    for force in (False, False, True):
        ingest(store, registry, contract, landing, "2024-01-05", force)
    return store.read("raw/nation").select("n_nationkey", "n_name", "n_regionkey", text_day("ingest_date"))
