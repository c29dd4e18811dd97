"""Claims' histories from repeated full exports: transitions, their order and class, kept as loads arrive late or again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import joined, same_text, sha_key
from ..operators.states import move_class
from ..sources.store import TableStore

#: The states of a claim, what may follow each, and which are final.
MOVES = {
    "Submitted": ["Under Review", "Rejected"],
    "Under Review": ["Partially Approved", "Approved", "Rejected"],
    "Partially Approved": ["Settled", "Rejected"],
    "Approved": ["Settled"],
    "Rejected": [],
    "Settled": [],
}
FINAL = ("Settled", "Rejected")

AUDIT, LIFECYCLE = "claims/audit", "claims/lifecycle"
CARRIED = ("patient_id", "hospital_id", "insurer_id", "claim_amount", "approved_amount", "submitted_date", "rejection_reason")


def normalized(raw: DataFrame, status: str = "final_status") -> DataFrame:
    """raw with typed dates and amounts and status_code in one style; rows without claim_id or status are left out. Values that
    can't be read are null."""
    days = [c for c in raw.columns if c.endswith("_date")]
    sums = [c for c in raw.columns if c.endswith("_amount")]
    out = raw.withColumns({c: F.col(c).try_cast("date") for c in days} | {c: F.col(c).try_cast("decimal(18,2)") for c in sums})
    out = out.withColumn("status_code", F.nullif(F.initcap(same_text(F.col(status))), F.lit("")))
    return out.dropna(subset=["claim_id", "status_code"])


def transitions(claims: DataFrame, carried: Sequence[str] = CARRIED) -> DataFrame:
    """One row for each (claim_id, status_code, status_date), with the export it was first observed in and what that said.

    An aggregate of the least export, nulls last and ties by the text of the row: a claim repeated in all exports shrinks
    before the shuffle. transition_key is a hash of the three and so the same in every run.
    """
    order = F.struct(F.col("export_date").isNull().alias("n"), "export_date", joined([F.col(c) for c in carried]).alias("t"))
    rows = claims.groupBy("claim_id", "status_code", "status_date").agg(F.min_by(F.struct(F.col("export_date").alias("first_observed_export"), *carried), order).alias("r"))
    return rows.select(sha_key([F.col(c) for c in ("claim_id", "status_code", "status_date")]).alias("transition_key"), "claim_id", "status_code", "status_date", "r.*")


def enriched(rows: DataFrame, moves: Mapping[str, Sequence[str]] = MOVES, final: Sequence[str] = FINAL) -> DataFrame:
    """Transitions in order: sequence, neighbours, days spent in the state before, whether final, class of the move, whether it
    can be at all. Windows go over one claim's different transitions."""
    w = Window.partitionBy("claim_id").orderBy("status_date", "status_code", "transition_key")
    out = rows.withColumns({"transition_seq": F.row_number().over(w), "prev_status": F.lag("status_code").over(w), "next_status": F.lead("status_code").over(w), "days_in_prev_status": F.datediff("status_date", F.lag("status_date").over(w))})
    out = out.withColumns({"is_terminal": F.col("status_code").isin(*final), "transition_class": move_class(F.col("prev_status"), F.col("status_code"), moves)})
    return out.withColumn("is_legal_transition", F.col("transition_class") != "ILLEGAL")


def take(store: TableStore, claims: DataFrame, moves: Mapping[str, Sequence[str]] = MOVES, final: Sequence[str] = FINAL) -> None:
    """Takes an export into the audit, insert-only, and derives the lifecycle of the claims it brought news of anew.

    A transition that arrives late is put where it belongs: its claim is renumbered from the audit, all others keep their rows.
    The same export again changes nothing. A transition seen earlier than the audit says does not change the audit.
    """
    new = transitions(claims)
    if store.exists(AUDIT):
        new = new.join(store.read(AUDIT).select("transition_key"), "transition_key", "left_anti")
    store.append(AUDIT, new)
    audit = store.read(AUDIT)
    if not store.exists(LIFECYCLE):
        store.overwrite(LIFECYCLE, enriched(audit, moves, final))
        return
    # what the lifecycle does not hold yet is news, also after a run that ended between the two writes
    news = audit.select("claim_id", "transition_key").join(store.read(LIFECYCLE).select("transition_key"), "transition_key", "left_anti").select("claim_id").distinct()
    store.upsert(LIFECYCLE, enriched(audit.join(news, "claim_id", "left_semi"), moves, final), ["transition_key"])


def latest_state(lifecycle: DataFrame) -> DataFrame:
    """Each claim's last transition, as an aggregate."""
    cols = [c for c in lifecycle.columns if c != "claim_id"]
    return lifecycle.groupBy("claim_id").agg(F.max_by(F.struct(*cols), F.struct("status_date", "transition_seq")).alias("r")).select("claim_id", "r.*")
