"""Raw files into an archive table: everything as text, with where and when it came from."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import Contract, check_headers
from .registry import Registry
from .store import TableStore

CORRUPT = "_corrupt_record"
_DAY = re.compile(r"(\d{4}-\d{2}-\d{2})")


def list_files(spark: SparkSession, folder: str, logical_date: date | str | None = None) -> list[str]:
    """Files of a source, undated (initial) ones first, then by the date in the name, up to logical_date."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if fs.exists(path):
        it = fs.listFiles(path, True)
        while it.hasNext():
            p = it.next().getPath()
            if not p.getName().startswith(("_", ".")):
                found.append(p.toString())
    dated = [(m[-1] if (m := _DAY.findall(p.rsplit("/", 1)[-1])) else "", p) for p in found]
    to = str(logical_date)[:10] if logical_date else "9999-12-31"
    return [p for d, p in sorted(dated) if d <= to]


def _unread(spark: SparkSession, files: Sequence[str], archived: DataFrame) -> list[str]:
    """Those of the files that are no source_file of the archived rows, in the same order: an anti join, so that only the new
    ones reach the driver, which listed them all."""
    one = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    uri = lambda f: spark._jvm.org.apache.hadoop.fs.Path(f).toUri().toString()  # noqa: E731  source_file is encoded, a listed path is not
    if not files:
        return []
    listed = spark.createDataFrame([(i, uri(f)) for i, f in enumerate(files)], "i int, f string").withColumn("f", one("f"))
    return [files[r["i"]] for r in listed.join(archived.select(one("source_file").alias("f")).distinct(), "f", "left_anti").orderBy("i").collect()]


def summary(store: TableStore, names: Sequence[str]) -> DataFrame:
    """(source, n_rows, n_files, n_batches) of each source's archive, zeros for those without one."""
    out = store.spark.createDataFrame([(n, 0, 0, 0) for n in names], "source string, n_rows bigint, n_files bigint, n_batches bigint").limit(0)
    for n in names:
        if store.exists(f"raw/{n}"):
            one = store.read(f"raw/{n}").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source_file").alias("n_files"), F.count_distinct("batch_id").alias("n_batches"))
        else:
            one = store.spark.createDataFrame([(0, 0, 0)], "n_rows bigint, n_files bigint, n_batches bigint")
        out = out.unionByName(one.withColumn("source", F.lit(n)))
    return out


def read_seed(spark: SparkSession, path: str, schema: str, unique: Sequence[str] = ()) -> DataFrame:
    """A seed CSV with a header, whose lines that begin with # are comments; of rows with equal `unique` columns the least stays."""
    df = spark.read.schema(schema).option("header", True).option("comment", "#").option("mode", "FAILFAST").csv(path)
    if not unique:
        return df
    rest = [c for c in df.columns if c not in unique]
    return df.groupBy(*unique).agg(F.min(F.struct(*rest)).alias("r")).select(*unique, "r.*") if rest else df.distinct()


def read_raw(spark: SparkSession, contract: Contract, paths: Sequence[str]) -> DataFrame:
    """Rows as text with source_file, ingest_date (from the file's name) and the raw line of rows that do not fit.

    CSV headers are checked in every file. Rows that are too short or too long are kept with _corrupt_record set.
    """
    check_headers(spark, contract, paths)
    reader = spark.read.schema(contract.raw_schema(CORRUPT)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.option("header", True).csv(list(paths)) if contract.format == "csv" else reader.json(list(paths))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    day = F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.try_to_date(day, "yyyy-MM-dd").alias("ingest_date"))


def ingest(store: TableStore, registry: Registry, contract: Contract, folder: str, logical_date: date | str, force: bool = False) -> str:
    """One source and date into raw/<name>. A batch that succeeded is skipped; forced, it replaces its own rows only.

    Reads the files up to the date that no other batch has in the archive, so late, undated and out-of-order ones are read by
    the next run; the mark only reports how far it went. Returns the batch's outcome (see Registry.run).
    """
    spark, name = store.spark, f"raw/{contract.name}"

    def step(batch: str) -> int:
        files = list_files(spark, folder, logical_date)
        if store.exists(name):  # what other batches have read stays theirs
            files = _unread(spark, files, store.read(name).filter(F.col("batch_id") != batch))
        if not files:
            return 0
        rows = read_raw(spark, contract, files).withColumns({"batch_id": F.lit(batch), "ingest_date": F.coalesce("ingest_date", F.lit(str(logical_date)[:10]).cast("date")), "ingestion_ts": F.current_timestamp()})
        store.replace_where(name, rows, F.col("batch_id") == batch)
        return store.read(name).filter(F.col("batch_id") == batch).count()

    return registry.run(logical_date, "raw", contract.name, step, force)


def ingest_all(store: TableStore, registry: Registry, contracts: Mapping[str, Contract], root: str, logical_date: date | str, force: bool = False) -> dict[str, str]:
    """Outcome by source, in order of names."""
    return {n: ingest(store, registry, contracts[n], f"{root}/{n}", logical_date, force) for n in sorted(contracts)}
