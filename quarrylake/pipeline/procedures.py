"""Codes of procedures: the latest version of each, with its own code or the one inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_procedure, surrogate_key
from ..operators.inference import infer_codes
from ..operators.windows import first_by


def coded(procedures: DataFrame, catalogue: DataFrame) -> DataFrame:
    """procedures: procedure_code, procedure_name, specialty, icd10_code, ingestion_ts, source_file. catalogue: procedure_name,
    specialty, icd10_code. Names are compared in their normal form (see normalize_procedure); tiers as in infer_codes."""
    latest = first_by(procedures.filter("procedure_code is not null"), ["procedure_code"], [F.desc_nulls_last("ingestion_ts"), F.desc_nulls_last("source_file")])
    latest = latest.withColumns({"__name": F.nullif(normalize_procedure(F.col("procedure_name")), F.lit("")), "icd10_code": F.nullif(F.trim("icd10_code"), F.lit(""))})
    known = catalogue.select(normalize_procedure(F.col("procedure_name")).alias("__name"), "specialty", "icd10_code")
    out = infer_codes(latest, known, "procedure_code", "__name", "specialty", "icd10_code")
    return out.drop("icd10_code", "__name").withColumnsRenamed({"inferred_code": "icd10_code", "tier": "icd10_source", "confidence": "icd10_confidence"})


def dim_procedure(rows: DataFrame) -> DataFrame:
    """coded() with key, chapter, whether inferred and how reliable."""
    c = F.col("icd10_confidence")
    band = F.when(c >= 0.95, "High").when(c >= 0.70, "Medium").when(c > 0, "Low").otherwise("None")
    return rows.withColumns({"procedure_sk": surrogate_key([F.col("procedure_code")]), "icd10_chapter": F.substring("icd10_code", 1, 1), "is_icd10_inferred": F.col("icd10_source") != "SOURCE", "icd10_reliability": band})
