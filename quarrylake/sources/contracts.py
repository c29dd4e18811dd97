"""Source contracts: what a raw file must look like."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = {"string": T.StringType, "int": T.IntegerType, "integer": T.IntegerType, "long": T.LongType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "date": T.DateType, "timestamp": T.TimestampType}


def parse_type(text: str) -> T.DataType:
    """Spark's type of a contract's; an error for any other."""
    found = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", text.strip())
    if found:
        return T.DecimalType(int(found[1]), int(found[2]))
    if text.strip() not in _SIMPLE:
        raise ValueError(f"unknown type in contract: {text!r}")
    return _SIMPLE[text.strip()]()


@dataclass(frozen=True)
class Contract:
    """name, format (csv or json lines), columns (name -> declared type), business key."""

    name: str
    format: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]

    def raw_schema(self, corrupt: str | None = None) -> T.StructType:
        """All columns as strings: raw data are kept as delivered and typed later."""
        names = [c for c, _ in self.columns] + ([corrupt] if corrupt else [])
        return T.StructType([T.StructField(c, T.StringType()) for c in names])

    def typed(self, df):
        """df with declared types; a value that can't be read is null and never an error."""
        return df.select(*[df[c].try_cast(parse_type(t)).alias(c) for c, t in self.columns], *[c for c in df.columns if c not in dict(self.columns)])


class HeaderError(ValueError):
    """A file's header is not the contract's."""


def check_headers(spark: SparkSession, contract: Contract, paths: Sequence[str]) -> None:
    """HeaderError that names missing and unexpected columns, for the first of all CSV files whose ordered header differs.

    The first split of each file is read, by tasks side by side; only the first file that differs reaches the driver.
    """
    if contract.format != "csv" or not paths:
        return
    want = [c for c, _ in contract.columns]
    lines = spark.read.text(list(paths), wholetext=False).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("line"))
    # lines of a split keep their order, so the least number of a file's first split is its header
    first = lines.filter("at = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))
    names = F.transform(F.split("header", ","), lambda x: F.regexp_replace(F.trim(x), '^\ufeff?"?|"$', ""))
    for r in first.withColumn("names", names).filter(F.col("names") != F.array(*map(F.lit, want))).orderBy("path").limit(1).collect():
        missing, extra = [c for c in want if c not in r["names"]], [c for c in r["names"] if c not in want]
        raise HeaderError(f"{contract.name}: {r['path']}: missing {missing}, unexpected {extra}" + ("" if missing or extra else ", order differs"))
