"""Queries p1, p5, p7, p8, p9 and p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .groups import groups_by_shared
from .linkage import claim_bill_pairs
from .names import person_pairs
from .packing import LINEAR, QUADRATIC, packed
from .subjects import subject_areas
from .tokenizer import encoded

CONTAINER = 2048


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Group of every registration over all match results."""
    return groups_by_shared(table(spark, folder, "patient_crosswalk"), "patient_id", "mpi_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of mpi_ids of one person."""
    pairs = person_pairs(table(spark, folder, "patient_master"), table(spark, folder, "nicknames"))
    return pairs.toDF("mpi_id_a", "mpi_id_b")


def p7_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Every claim and its bill with the confidence."""
    return claim_bill_pairs(table(spark, folder, "claims"), table(spark, folder, "bills"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every claim and the delivered bill it was made for."""
    return p7_matches(spark, folder).select("claim_id", "bill_id")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return encoded(table(spark, folder, "documents"))


def p9_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Container of every document, or of every piece of one longer than a container."""
    sizes = written(encoded(table(spark, folder, "documents"), counts=True), "sizes")
    return packed(sizes, "doc_id", "n_tokens", CONTAINER)


def p8_counts(spark: SparkSession, folder: str) -> DataFrame:
    """By language: documents, those whose list is empty, and documents whose list and text are not empty together."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", (F.coalesce(F.length("text"), F.lit(0)) == 0).alias("blank"))
    ids = p8_ids(spark, folder).select("doc_id", (F.size("ids") == 0).alias("empty"))
    n = lambda c: F.sum(c.cast("bigint"))
    return docs.join(ids, "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), n(F.col("empty")).alias("n_empty"), n(F.col("empty") != F.col("blank")).alias("n_wrong"))


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """How full and how even the containers are: one row with their number, the tokens, the room unused, and the mean, spread
    and greatest attention cost of a container."""
    cost = F.lit(LINEAR) * F.col("n") + F.lit(QUADRATIC) * F.col("n") * F.col("n")
    by = p9_packed(spark, folder).groupBy("container_id").agg(F.sum("n").alias("load"), F.sum(cost).alias("cost"))
    told = by.agg(F.count(F.lit(1)).alias("n_containers"), F.sum("load").alias("n_tokens"), F.max("load").alias("max_load"), F.avg("cost").alias("mean_cost"), F.stddev_pop("cost").alias("sd_cost"), F.max("cost").alias("max_cost"))
    return told.withColumn("unused_share", 1 - F.col("n_tokens") / (F.col("n_containers") * F.lit(CONTAINER)))


def p9_balance(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of every packing: documents placed, containers beyond their capacity, documents that were split though
    they fit, and pieces that do not follow one another without a gap."""
    rows = written(p9_packed(spark, folder), "packed")
    over = rows.groupBy("container_id").agg(F.sum("n").alias("load")).agg(F.count_if(F.col("load") > CONTAINER).alias("n_overfull"))
    docs = rows.groupBy("doc_id").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("pieces"), F.max(F.col("first") + F.col("n")).alias("end"))
    told = docs.agg(F.count(F.lit(1)).alias("n_placed"), F.count_if((F.col("size") <= CONTAINER) & (F.col("pieces") > 1)).alias("n_split"), F.count_if(F.col("end") != F.col("size")).alias("n_gaps"))
    both = told.unionByName(over, True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Subjects of every document."""
    return subject_areas(*(table(spark, folder, t) for t in ("documents", "subject_labels", "subjects")))


QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p7_found": p7_found, "p7_matches": p7_matches, "p8_ids": p8_ids, "p8_counts": p8_counts, "p9_packed": p9_packed, "p9_report": p9_report, "p9_balance": p9_balance, "p10_found": p10_found}

ORACLE = {
    "p8_counts": "select lang, count(*) as n_docs, count(*) filter (where coalesce(text, '') = '') as n_empty, 0::bigint as n_wrong from documents group by lang",
    "p9_balance": "select count(*) filter (where coalesce(text, '') <> '') as n_placed, 0::bigint as n_split, 0::bigint as n_gaps, 0::bigint as n_overfull from documents",
    "p1_found": """
with recursive links as (
  select distinct a.patient_id as p, b.patient_id as q
  from patient_crosswalk a join patient_crosswalk b on a.mpi_id = b.mpi_id
  where a.patient_id is not null and b.patient_id is not null),
reached(p, q) as (select p, q from links union select r.p, l.q from reached r join links l on r.q = l.p),
every as (select distinct patient_id as p from patient_crosswalk where patient_id is not null)
select e.p as patient_id, least(e.p, coalesce(min(r.q), e.p)) as group_id from every e left join reached r on e.p = r.p group by e.p""",
}
