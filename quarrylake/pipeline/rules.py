"""Reference tables and the rule that applies to each row. What a rule then does to prices is no part of this library."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import wildcard_match
from ..operators.lookup import lookup
from ..sources.ingest import read_seed

SEEDS = {
    "rules": ("rule_id string, insurer_id string, procedure_category string, room_type string, copay_pct double, room_rent_cap_per_day double, priority int, effective_from date, effective_to date", ("rule_id",)),
    "exclusions": ("insurer_id string, item_category string, exclusion_pct double, effective_from date, effective_to date", ("insurer_id", "item_category", "effective_from")),
    "holidays": ("holiday_date date, holiday_name string, holiday_type string", ()),
    "date_formats": ("source string, format string", ("source",)),
}


def load_seeds(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Typed seed tables by name; lines that begin with # are comments."""
    return {n: read_seed(spark, p, *SEEDS[n]) for n, p in paths.items()}


def resolve_rules(rows: DataFrame, rules: DataFrame, on: Sequence[str], day: str, zeros: Sequence[str] = ()) -> DataFrame:
    """Each row with its best rule on its day: equal or wildcard in every column, least priority, then least rule_id. The
    columns `zeros` are 0 where no rule applies."""
    out = wildcard_match(rows, rules, on, "", [F.asc_nulls_last("rule_priority")], day)
    return out.withColumns({f"rule_{c}": F.coalesce(F.col(f"rule_{c}"), F.lit(0.0)) for c in zeros}) if zeros else out


def lookup_or(rows: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, Column]) -> DataFrame:
    """rows with the columns of `defaults` from the table's row of the key, or the default where there is none or it is null.
    The table has one row for a key; hot keys are split."""
    out = lookup(rows, table.select(*on, *[F.col(c).alias(f"__d_{c}") for c in defaults]), on)
    return out.withColumns({c: F.coalesce(F.col(f"__d_{c}"), d) for c, d in defaults.items()}).drop(*[f"__d_{c}" for c in defaults])
