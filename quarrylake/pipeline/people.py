"""People behind registrations: normal forms, candidate pairs, scores, decisions, ids that stay, master and crosswalk."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_by_source
from ..functions.similarity import jaro_winkler
from ..functions.text import normalize_name, normalize_phone, phone_last4, sha_key
from ..operators.entity import assign_stable_ids, block_pairs, exact_links, id_aliases, survivors, three_way, weighted_score
from ..operators.graph import components
from ..operators.lookup import hot_keys, lookup
from ..operators.windows import first_by
from ..session import written
from ..sources.store import TableStore

#: Weights of the parts of a score, and from where a pair is linked or looked at.
WEIGHTS = {"name": 0.40, "dob": 0.30, "phone": 0.20, "city": 0.10}
ACCEPT, REVIEW = 0.90, 0.75

REGISTRY, ALIASES, QUEUE, MASTER, CROSSWALK = "people/registry", "people/aliases", "people/review", "people/master", "people/crosswalk"


def registrations(raw: DataFrame, formats: Mapping[str, str] | None = None) -> DataFrame:
    """Normal form of the latest row of each (hospital_id, patient_id).

    raw: hospital_id, patient_id, name, dob (text, in the format of the hospital or ISO), phone, city, gender, updated. Gives
    record_id, full_name, first_name, last_name, dob, dob_parse_failed, phone, phone_last4, city, gender (first letter),
    exact_key (of name, birth date and last four digits, only if all are there) and updated. What can't be read is null and
    never an error; rows without hospital or patient are left out; other columns are not read.
    """
    rows = raw.select("hospital_id", "patient_id", "name", F.col("dob").cast("string").alias("dob"), "phone", "city", "gender", "updated").dropna(subset=["hospital_id", "patient_id"])
    rows = first_by(rows, ["hospital_id", "patient_id"], [F.col("updated").desc_nulls_last()])
    blank = lambda c: F.nullif(c, F.lit(""))
    rows = rows.withColumn("full_name", blank(normalize_name(F.col("name")))).withColumn("words", F.split("full_name", " "))
    parsed = parse_by_source(F.col("dob"), F.col("hospital_id"), formats or {})
    key = [F.col("full_name"), F.col("birth"), F.col("last4")]
    rows = rows.withColumns({"birth": parsed, "last4": phone_last4(F.col("phone"))})
    return rows.select(
        sha_key([F.col("hospital_id"), F.col("patient_id")]).alias("record_id"), "hospital_id", "patient_id", "full_name",
        F.get("words", F.lit(0)).alias("first_name"), F.when(F.size("words") > 1, F.element_at("words", -1)).alias("last_name"),
        F.col("birth").alias("dob"), (F.col("dob").isNotNull() & F.col("birth").isNull()).alias("dob_parse_failed"),
        normalize_phone(F.col("phone")).alias("phone"), F.col("last4").alias("phone_last4"), blank(F.upper(F.trim("city"))).alias("city"),
        blank(F.upper(F.substring(F.trim("gender"), 1, 1))).alias("gender"),
        F.when(key[0].isNotNull() & key[1].isNotNull() & key[2].isNotNull(), sha_key(key)).alias("exact_key"), "updated",
    )


def block_strategies() -> dict[str, Column]:
    """The four keys by which two registrations become a candidate pair; a key with a missing part makes no block."""
    first, last = F.soundex("first_name"), F.soundex("last_name")
    whole = lambda *parts: F.when(F.greatest(*[p.isNull() for p in parts], F.lit(False)) == F.lit(False), F.concat_ws("|", *parts))
    return {
        "phone": F.col("phone"),
        "sound_date": whole(first, F.col("dob").cast("string")),
        "sounds_year": whole(first, last, F.year("dob").cast("string")),
        "sounds_city": whole(first, last, F.col("city")),
    }


def classes(regs: DataFrame) -> DataFrame:
    """(record_id, class_id): registrations alike in all that is compared, under the least record of them. Pairs are made of
    class representatives only, so copies, however many, make no pairs among themselves."""
    alike = ["full_name", "dob", "phone", "city", "gender"]
    # structs take null for equal to null
    rows = regs.select("record_id", F.struct(*alike).alias("__k"))
    return lookup(rows, rows.groupBy("__k").agg(F.min("record_id").alias("class_id")), ["__k"], "inner").select("record_id", "class_id")


def candidates(regs: DataFrame) -> DataFrame:
    """(a, b, strategies), a < b: pairs of class representatives that share a block of any size, with all strategies that made
    them. A block's pairs are made in cells, so that a hot one is spread (see block_pairs)."""
    heads = regs.join(classes(regs).select(F.col("class_id").alias("record_id")).distinct(), "record_id", "left_semi")
    return block_pairs(heads, "record_id", block_strategies())


def score(pairs: DataFrame, regs: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """pairs with name_sim, dob_sim, phone_sim, city_sim, gender_conflict and match_score.

    dob: 1 equal, 0.75 day and month swapped or a day off, 0.35 the same year, else 0. phone: 1 equal, 0.85 one edit or two
    digits swapped, 0.45 two edits, else 0. city: equal or not. A missing part has no weight (but a missing name counts as 0).
    Two genders halve the score of names below 0.95.
    """
    x, y = (regs.select(*[F.col(c).alias(f"{c}_{s}") for c in ("record_id", "full_name", "dob", "phone", "city", "gender")]) for s in "ab")
    hot = {c: hot_keys(pairs, [c]) for c in "ab"}  # of the pairs as they are, before either join
    p = lookup(pairs, x.withColumnRenamed("record_id_a", "a"), ["a"], "inner", hot=hot["a"])
    p = lookup(p, y.withColumnRenamed("record_id_b", "b"), ["b"], "inner", hot=hot["b"])
    a, b = (lambda c: F.col(f"{c}_a")), (lambda c: F.col(f"{c}_b"))
    known = lambda c: a(c).isNotNull() & b(c).isNotNull()
    swapped = (F.year(a("dob")) == F.year(b("dob"))) & (F.month(a("dob")) == F.dayofmonth(b("dob"))) & (F.dayofmonth(a("dob")) == F.month(b("dob")))
    off = F.abs(F.datediff(a("dob"), b("dob")))
    dob = F.when(off == 0, 1.0).when(swapped | (off <= 1), 0.75).when(F.year(a("dob")) == F.year(b("dob")), 0.35).otherwise(0.0)
    edits = F.levenshtein(a("phone"), b("phone"))
    digits = lambda c: F.sort_array(F.split(c, ""))
    phone = F.when(edits == 0, 1.0).when((edits == 1) | ((edits == 2) & (digits(a("phone")) == digits(b("phone")))), 0.85).when(edits == 2, 0.45).otherwise(0.0)
    p = p.withColumns({
        "name_sim": F.round(jaro_winkler(a("full_name"), b("full_name")), 6), "dob_sim": F.when(known("dob"), dob), "phone_sim": F.when(known("phone"), phone),
        "city_sim": F.when(known("city"), F.when(a("city") == b("city"), 1.0).otherwise(0.0)), "gender_conflict": known("gender") & F.coalesce(a("gender") != b("gender"), F.lit(False)),
    })
    p = p.withColumn("match_score", weighted_score({n: F.col(f"{n}_sim") for n in weights}, weights))
    half = F.col("gender_conflict") & (F.col("name_sim") < 0.95)
    p = p.withColumn("match_score", F.when(half, F.col("match_score") * 0.5).otherwise(F.col("match_score")))
    return p.select(*pairs.columns, "name_sim", "dob_sim", "phone_sim", "city_sim", "gender_conflict", "match_score")


@dataclass(frozen=True)
class Resolved:
    """links (a, b, match_score), the queue of pairs to be looked at, and clusters (record_id, label)."""

    links: DataFrame
    queue: DataFrame
    clusters: DataFrame


def decide(regs: DataFrame, accept: float = ACCEPT, review: float = REVIEW) -> Resolved:
    """Pairs linked, queued or let go, and the clusters of the linked ones; registrations without a link are clusters of one."""
    scored = written(score(written(candidates(regs), "pairs"), regs), "scored").withColumn("outcome", three_way(F.col("match_score"), accept, review))
    exact = exact_links(regs, "record_id", "exact_key").withColumn("match_score", F.lit(1.0))
    copies = classes(regs).filter("record_id <> class_id").select(F.col("class_id").alias("a"), F.col("record_id").alias("b"), F.lit(1.0).alias("match_score"))
    auto = scored.filter("outcome = 'match'").select("a", "b", "match_score")
    links = written(auto.unionByName(exact).unionByName(copies), "links")
    joined = components(links, "a", "b").select(F.col("node").alias("record_id"), "label")
    alone = regs.select("record_id").join(joined, "record_id", "left_anti").withColumn("label", F.col("record_id"))
    queue = scored.filter("outcome = 'review'").drop("outcome").withColumn("decision", F.lit("PENDING"))
    return Resolved(links, queue, joined.unionByName(alone))


def resolve(store: TableStore, regs: DataFrame, prefix: str = "MPI", accept: float = ACCEPT, review: float = REVIEW) -> None:
    """Resolves the registrations and writes registry, aliases, review queue, master and crosswalk into the store.

    The registry keeps every record's id: a cluster takes the least id of its records in it, so growing or merging clusters
    mint no new ids, and an id given up in a merge is kept in the aliases with the one that took its place. Of a person's
    registrations the newest makes the master row. Running again with the same registrations changes nothing.
    """
    regs = written(regs, "registrations")
    found = decide(regs, accept, review)
    registry = store.read(REGISTRY) if store.exists(REGISTRY) else None
    known = None if registry is None else registry.select("record_id", F.regexp_extract("mpi_id", r"(\d+)$", 1).cast("bigint").alias("entity_id"))
    ids = written(assign_stable_ids(found.clusters, known, "record_id", "label"), "ids")
    name = lambda c: F.concat(F.lit(prefix), F.lpad(F.col(c).cast("string"), 9, "0"))
    given = written(ids.select("record_id", name("entity_id").alias("mpi_id")), "given")
    if known is not None:
        gone = id_aliases(ids, known, "record_id")
        store.insert_new(ALIASES, gone.select(name("old_id").alias("old_mpi_id"), name("entity_id").alias("mpi_id")), ["old_mpi_id", "mpi_id"])
    store.upsert(REGISTRY, given, ["record_id"])
    store.overwrite(QUEUE, found.queue)
    people = written(regs.join(given, "record_id"), "people")
    store.overwrite(MASTER, master(people))
    store.overwrite(CROSSWALK, crosswalk(people, found.links))


def master(people: DataFrame) -> DataFrame:
    """One row for each mpi_id: the newest registration, with how many registrations and hospitals it was made of."""
    out = survivors(people, "mpi_id", [F.col("updated").desc_nulls_last(), F.asc("record_id")], "hospital_id")
    return out.select("mpi_id", "full_name", "dob", "phone", "city", "gender", "updated", F.col("n_records").alias("source_record_count"), F.col("n_sources").alias("source_hospital_count"), F.col("source_set").alias("hospitals"))


def crosswalk(people: DataFrame, links: DataFrame) -> DataFrame:
    """Each registration with its mpi_id and what speaks for it: an exact key, and the best score of its links (null: none)."""
    ends = F.array(F.struct(F.col("a").alias("record_id"), "match_score"), F.struct(F.col("b").alias("record_id"), "match_score"))
    best = links.select(F.inline(ends)).groupBy("record_id").agg(F.max("match_score").alias("match_score"))
    return people.join(best, "record_id", "left").select("mpi_id", "hospital_id", "patient_id", "record_id", "full_name", "dob", "phone", F.col("exact_key").isNotNull().alias("had_exact_key"), "match_score")

