"""Versioned tables on plain Parquet: atomic commits, appends and replacements that touch only their files, merges, time
travel, checksums.

A table is a folder of loads (data/__load=<id>/..., partitioned below where asked for) and one manifest per version
(_versions/<n>.json) that says which loads, or which files of a load, make the version. A writer adds a load and then creates
the next manifest by a rename that fails if another writer was first, so readers see the old or the new version and never a
part, and of two writers at once one gets an error and changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import joined

VERSIONS, DATA, LOAD = "_versions", "data", "__load"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class TableStore:
    """Tables below a root folder of any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _path(self, name: str) -> str:
        if not re.fullmatch(r"[\w./-]+", name) or ".." in name:
            raise ValueError(f"no name for a table: {name!r}")
        return f"{self.root}/{name}"

    # --- manifests ---------------------------------------------------------------------------------------------------

    def versions(self, name: str) -> list[int]:
        """Versions that can be read, oldest first."""
        fs, p = self._fs(f"{self._path(name)}/{VERSIONS}")
        if not fs.exists(p):
            return []
        return sorted(int(m[1]) for s in fs.listStatus(p) if (m := re.fullmatch(r"(\d+)\.json", s.getPath().getName())))

    def _manifest(self, name: str, version: int | None = None) -> dict | None:
        if version is None:
            version = max(self.versions(name), default=None)
            if version is None:
                return None
        fs, p = self._fs(f"{self._path(name)}/{VERSIONS}/{version}.json")
        if not fs.exists(p):
            raise FileNotFoundError(f"no version {version} of {name}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, before: dict | None, loads: dict, schema: StructType, partition_by: Sequence[str]) -> int:
        version = before["version"] + 1 if before else 1
        folder = f"{self._path(name)}/{VERSIONS}"
        fs, new = self._fs(f"{folder}/.{uuid.uuid4().hex}")
        out = fs.create(new, True)
        out.write(json.dumps({"version": version, "schema": schema.json(), "partition_by": list(partition_by), "loads": loads}).encode())
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(new, self._fs(f"{folder}/{version}.json")[1], options)
        except Exception as e:
            fs.delete(new, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentWrite(f"{name} has a version {version} already") from e
            raise
        return version

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = (), rows_a_file: int = 0) -> str:
        load = uuid.uuid4().hex
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        writer = df.write.option("maxRecordsPerFile", rows_a_file) if rows_a_file else df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self._path(name)}/{DATA}/{LOAD}={load}")
        return load

    def _files(self, name: str, load: str) -> list[tuple[str, int]]:
        """(path below the load, bytes) of its files."""
        fs, p = self._fs(f"{self._path(name)}/{DATA}/{LOAD}={load}")
        out, it = [], fs.listFiles(p, True) if fs.exists(p) else None
        while it is not None and it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(".parquet"):
                out.append((f.getPath().toString().split(f"/{LOAD}={load}/", 1)[1], f.getLen()))
        return sorted(out)

    # --- reading -----------------------------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def _scan(self, name: str, m: dict) -> DataFrame:
        schema, base = StructType.fromJson(json.loads(m["schema"])), f"{self._path(name)}/{DATA}"
        paths = [p for load, files in m["loads"].items() for p in ([f"{base}/{LOAD}={load}"] if files is None else [f"{base}/{LOAD}={load}/{f}" for f in files])]
        # a load that wrote no file (empty and partitioned) has nothing to scan
        if not paths or not any(files or self._files(name, load) for load, files in m["loads"].items()):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The current or an older version; an error if there is none. Filters on partition columns prune folders."""
        m = self._manifest(name, version)
        if m is None:
            raise FileNotFoundError(f"no table {name}")
        df = self._scan(name, m)
        return df.select(*[f"`{c}`" for c in StructType.fromJson(json.loads(m["schema"])).names])

    def read_or_empty(self, name: str, like: DataFrame) -> DataFrame:
        return self.read(name) if self.exists(name) else self.spark.createDataFrame([], like.schema)

    def row_count(self, name: str) -> int:
        """Rows of the table, 0 if it does not exist."""
        return self.read(name).count() if self.exists(name) else 0

    def file_count(self, name: str, version: int | None = None) -> int:
        m = self._manifest(name, version)
        return sum(len(files if files is not None else self._files(name, load)) for load, files in m["loads"].items()) if m else 0

    # --- writing -----------------------------------------------------------------------------------------------------

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), rows_a_file: int = 0) -> int:
        """df as the new version, with its own schema and partitions; returns the version. df may read the table itself."""
        before = self._manifest(name)
        return self._commit(name, before, {self._write(name, df, partition_by, sort_by, rows_a_file): None}, df.schema, partition_by)

    def append(self, name: str, df: DataFrame) -> int:
        """Adds rows as a load of their own: nothing that is there is read or written. Columns of the table that df lacks are
        null, columns that it adds are null in older rows; types are the table's."""
        before = self._manifest(name)
        if before is None:
            return self.overwrite(name, df)
        df, schema = self._fitted(before, df)
        return self._commit(name, before, {**before["loads"], self._write(name, df, before["partition_by"]): None}, schema, before["partition_by"])

    def _fitted(self, m: dict, df: DataFrame) -> tuple[DataFrame, StructType]:
        """df with the table's types and columns in their order, and the schema of both together."""
        schema = StructType.fromJson(json.loads(m["schema"]))
        here = {c for c in df.columns}
        old = [(F.col(f"`{f.name}`") if f.name in here else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        more = [f for f in df.schema if f.name not in schema.names]
        return df.select(*old, *[F.col(f"`{f.name}`") for f in more]), StructType([*schema, *more])

    def _touched(self, rows: DataFrame) -> list[str]:
        """Files (load/path) named in __file: at most the table's files."""
        return [unquote(r["__file"]).split(f"/{DATA}/{LOAD}=", 1)[1] for r in rows.select("__file").distinct().collect()]

    def _without(self, name: str, m: dict, files: Sequence[str]) -> dict:
        """Loads of the manifest without those files."""
        gone: dict[str, set[str]] = {}
        for f in files:
            load, rest = f.split("/", 1)
            gone.setdefault(load, set()).add(rest)
        out = {}
        for load, own in m["loads"].items():
            if load not in gone:
                out[load] = own
                continue
            left = [f for f in (own if own is not None else [f for f, _ in self._files(name, load)]) if f not in gone[load]]
            if left:
                out[load] = left
        return out

    def _rewrite(self, name: str, m: dict, files: Sequence[str], df: DataFrame) -> int:
        """Commits df in place of the files."""
        df, schema = self._fitted(m, df)
        load = self._write(name, df, m["partition_by"])
        return self._commit(name, m, {**self._without(name, m, files), load: None}, schema, m["partition_by"])

    def _of(self, name: str, m: dict, files: Sequence[str]) -> DataFrame:
        by_load: dict[str, list[str]] = {}
        for f in files:
            load, rest = f.split("/", 1)
            by_load.setdefault(load, []).append(rest)
        return self._scan(name, m | {"loads": by_load}).select(*[f"`{c}`" for c in StructType.fromJson(json.loads(m["schema"])).names])

    def _keyed(self, name: str, m: dict, source: DataFrame, keys: Sequence[str]) -> list[str]:
        """Files with a row whose keys are in source (nulls equal)."""
        if not self.file_count(name):
            return []
        rows = self._scan(name, m).select(*[f"`{k}`" for k in keys], F.col("_metadata.file_path").alias("__file"))
        one = source.select(*[F.col(f"`{k}`").alias(f"__s_{i}") for i, k in enumerate(keys)]).distinct()
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"__s_{i}"))
        return self._touched(rows.join(one, cond, "left_semi"))

    def upsert(self, name: str, source: DataFrame, keys: Sequence[str]) -> int:
        """Rows of source replace those with equal keys (nulls equal) and are added otherwise. Keys must be unique in source.
        Only files with such rows are written anew."""
        m = self._manifest(name)
        if m is None:
            return self.overwrite(name, source)
        files = self._keyed(name, m, source, keys)
        target = self._of(name, m, files)
        return self._rewrite(name, m, files, target.join(source, _equal(target, source, keys), "left_anti").unionByName(source, allowMissingColumns=True))

    def insert_new(self, name: str, source: DataFrame, keys: Sequence[str]) -> int:
        """Adds rows whose keys are not there yet, as a load of their own; replaying the same source changes nothing."""
        m = self._manifest(name)
        if m is None:
            return self.overwrite(name, source)
        target = self.read(name)
        return self.append(name, source.join(target, _equal(source, target, keys), "left_anti"))

    def merge(self, name: str, source: DataFrame, keys: Sequence[str], update: Sequence[str], when: Callable[[DataFrame, DataFrame], Column] | None = None) -> int:
        """Full merge: of rows with equal keys the columns `update` are taken from source where `when` holds (target, source),
        all others stay; rows without a partner are kept or added. Columns are the target's. Only files with such rows are
        written anew."""
        m = self._manifest(name)
        if m is None:
            return self.overwrite(name, source)
        files = self._keyed(name, m, source, keys)
        return self._rewrite(name, m, files, merged(self._of(name, m, files), source, keys, update, when))

    def replace_where(self, name: str, df: DataFrame, predicate: Column) -> int:
        """Replaces the rows for which the predicate holds by df, so that a batch can be written again. Only files with such
        rows are written anew; a predicate on partition columns finds them without reading any."""
        m = self._manifest(name)
        if m is None:
            return self.overwrite(name, df)
        files = self._touched(self._scan(name, m).filter(predicate).select(F.col("_metadata.file_path").alias("__file"))) if self.file_count(name) else []
        kept = self._of(name, m, files).filter(~F.coalesce(predicate, F.lit(False)))
        return self._rewrite(name, m, files, kept.unionByName(df, allowMissingColumns=True))

    def compact(self, name: str, below: int = 64 << 20, sort_by: Sequence[str] = (), rows_a_file: int = 0) -> int:
        """Files of fewer bytes than `below` put together into larger ones, sorted if asked for; returns the version."""
        m = self._manifest(name)
        small = [f"{load}/{f}" for load, own in m["loads"].items() for f, size in self._files(name, load) if size < below and (own is None or f in own)]
        if len(small) < 2:
            return m["version"]
        df = self._of(name, m, small)
        load = self._write(name, df if sort_by else df.coalesce(max(1, len(small) // 8)), m["partition_by"], sort_by, rows_a_file)
        return self._commit(name, m, {**self._without(name, m, small), load: None}, df.schema, m["partition_by"])

    def vacuum(self, name: str, keep: int = 2) -> list[int]:
        """Forgets all versions but the current and the `keep` latest, and deletes loads and files that no kept version has
        (those of failed writes too); returns the versions forgotten."""
        every = self.versions(name)
        stay = every[-max(keep, 1):]
        gone, base = every[: -max(keep, 1)], self._path(name)
        for v in gone:
            fs, p = self._fs(f"{base}/{VERSIONS}/{v}.json")
            fs.delete(p, False)
        used: dict[str, set | None] = {}
        for v in stay:
            for load, files in self._manifest(name, v)["loads"].items():
                used[load] = None if files is None or used.get(load, set()) is None else used.get(load, set()) | set(files)
        fs, p = self._fs(f"{base}/{DATA}")
        for s in fs.listStatus(p) if fs.exists(p) else []:
            load = s.getPath().getName().removeprefix(f"{LOAD}=")
            if load not in used:
                fs.delete(s.getPath(), True)
            elif used[load] is not None:
                for f, _ in self._files(name, load):
                    if f not in used[load]:
                        fs.delete(self._fs(f"{base}/{DATA}/{LOAD}={load}/{f}")[1], False)
        return gone

    def register_views(self, names: Sequence[str]) -> list[str]:
        """Makes each existing table a temporary view (last part of its name); returns those that are missing."""
        missing = []
        for n in names:
            if self.exists(n):
                self.read(n).createOrReplaceTempView(n.rsplit("/", 1)[-1])
            else:
                missing.append(n)
        return missing

    def register_table(self, name: str, database: str) -> str:
        """The current version as a persistent view <database>.<last part>, over an external table at its loads: what a
        catalogue's users see until it is registered again. Returns the view's name."""
        m = self._manifest(name)
        schema, view = StructType.fromJson(json.loads(m["schema"])), f"`{database}`.`{name.rsplit('/', 1)[-1]}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        every = f"`{database}`.`__all_{name.rsplit('/', 1)[-1]}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {every}")
        where = " OR ".join([f"{LOAD} = '{load}'" for load, files in m["loads"].items() if files is None] + [f"({LOAD} = '{load}' AND element_at(split(_metadata.file_path, '/'), -1) IN ({', '.join(repr(f.rsplit('/', 1)[-1]) for f in files)}))" for load, files in m["loads"].items() if files is not None]) or "false"
        data = [f for f in schema if f.name not in m["partition_by"]]
        folders = [f"`{LOAD}` STRING", *[f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name in m["partition_by"]]]
        columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in data] + folders)
        self.spark.sql(f"CREATE TABLE {every} ({columns}) USING parquet PARTITIONED BY ({', '.join([f'`{LOAD}`', *[f'`{c}`' for c in m['partition_by']]])}) LOCATION '{self._path(name)}/{DATA}'")
        self.spark.sql(f"MSCK REPAIR TABLE {every}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(f'`{c}`' for c in schema.names)} FROM {every} WHERE {where}")
        return view


def _equal(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & target[k].eqNullSafe(source[k])
    return cond


def self_check(spark: SparkSession, root: str) -> dict[str, bool]:
    """Whether a store below root can write, read, merge, travel in time and clean up; the table is removed again."""
    store, name = TableStore(spark, root), f"self_check_{uuid.uuid4().hex}"
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    told = lambda version=None: sorted(map(tuple, store.read(name, version).collect()))
    out = {}
    try:
        out["write"] = store.overwrite(name, rows((1, "a"), (2, "b"))) == 1
        out["read"] = told() == [(1, "a"), (2, "b")]
        store.merge(name, rows((2, "c"), (3, "d")), ["k"], ["v"])
        out["merge"] = told() == [(1, "a"), (2, "c"), (3, "d")]
        out["time_travel"] = told(1) == [(1, "a"), (2, "b")]
        out["vacuum"] = store.vacuum(name, 1) == [1] and len(told()) == 3
    finally:
        fs, p = store._fs(store._path(name))
        fs.delete(p, True)
    return out


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], when: Callable[[DataFrame, DataFrame], Column] | None = None) -> DataFrame:
    """What `TableStore.merge` writes, as a full outer join and a projection."""
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), source.withColumn("__s", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    old, new = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    change = when(F.col, F.col) if when else F.lit(True)
    cols = []
    for c in target.columns:
        if c not in source.columns:
            cols.append(F.col(f"t.{c}").alias(c))
        elif c in update:
            cols.append(F.when(new & (~old | F.coalesce(change, F.lit(False))), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return t.join(s, cond, "full").select(*cols)


def checksum(df: DataFrame, keys: Sequence[str]) -> str:
    """'rows:sum of hashes' over the keys, whatever the order of rows or partitions."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(joined([F.col(k) for k in keys])).cast("decimal(38,0)")).alias("s")).first()
    return f"{r['n']}:{r['s'] or 0}"
