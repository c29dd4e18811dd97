import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylake.plans.questions import panels
from quarrylake.sources.contracts import Contract, HeaderError, check_headers, parse_type
from quarrylake.sources.ingest import CORRUPT, ingest, list_files, read_raw
from quarrylake.sources.registry import BATCHES, Registry, batch_id
from quarrylake.sources.sinks import markdown, plain, write_panels
from quarrylake.sources.store import ConcurrentWrite, TableStore, checksum, self_check
from quarrylake.streaming.arrivals import arrive, windowed_counts

C = Contract("people", "csv", (("id", "int"), ("name", "string"), ("amount", "decimal(18,2)")), ("id",))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_types():
    assert parse_type("decimal(18,2)") == T.DecimalType(18, 2) and parse_type("bigint") == T.LongType()
    with pytest.raises(ValueError):
        parse_type("blob")


def test_batch_ids():
    from datetime import date

    assert batch_id(date(2024, 1, 2), "raw", "x") == batch_id("2024-01-02", "raw", "x")
    assert len({batch_id("2024-01-02", "raw", "x"), batch_id("2024-01-03", "raw", "x"), batch_id("2024-01-02", "s", "x"), batch_id("2024-01-02", "raw", "y")}) == 4


def test_headers_of_every_file(spark, tmp_path):
    put(tmp_path / "a.csv", "id,name,amount\n1,x,2\n")
    check_headers(spark, C, [str(tmp_path / "a.csv")])
    put(tmp_path / "b.csv", "name,id,amount\nx,1,2\n")
    with pytest.raises(HeaderError, match="order differs"):
        check_headers(spark, C, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    put(tmp_path / "b.csv", "id,nom,amount\n1,x,2\n")
    with pytest.raises(HeaderError, match=r"missing \['name'\], unexpected \['nom'\]"):
        check_headers(spark, C, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])


def test_raw_rows_keep_text_and_mark_bad_ones(spark, tmp_path):
    put(tmp_path / "p_2024-01-05.csv", 'id,name,amount\n1,x,"1,25,000"\n2,y\n3,z,4,5\n')
    df = read_raw(spark, C, [str(tmp_path / "p_2024-01-05.csv")]).cache()
    assert df.count() == 3 and df.filter(F.col(CORRUPT).isNotNull()).count() == 2
    assert {str(r["ingest_date"]) for r in df.collect()} == {"2024-01-05"}
    assert [r["amount"] for r in C.typed(df).orderBy("id").collect()] == [None, None, 4]


def test_ingest_once_forced_and_by_date(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    reg, land = Registry(store), tmp_path / "landing"
    put(land / "initial.csv", "id,name,amount\n1,x,2\n")
    put(land / "people_2024-01-05.csv", "id,name,amount\n2,y,2\n")
    put(land / "people_2024-02-05.csv", "id,name,amount\n3,z,2\n")
    assert [p.rsplit("/", 1)[-1] for p in list_files(spark, str(land), "2024-01-31")] == ["initial.csv", "people_2024-01-05.csv"]
    assert ingest(store, reg, C, str(land), "2024-01-31") == "SUCCEEDED"
    assert ingest(store, reg, C, str(land), "2024-01-31") == "SKIPPED"
    one = checksum(store.read("raw/people"), ["id", "name", "batch_id"])
    assert ingest(store, reg, C, str(land), "2024-01-31", force=True) == "SUCCEEDED"
    assert checksum(store.read("raw/people"), ["id", "name", "batch_id"]) == one
    assert ingest(store, reg, C, str(land), "2024-02-28") == "SUCCEEDED"
    assert store.read("raw/people").count() == 3 and reg.mark("raw", "people") == "2024-02-28"
    put(land / "people_2024-03-05.csv", "id,nom,amount\n3,z,2\n")
    with pytest.raises(HeaderError):
        ingest(store, reg, C, str(land), "2024-03-31")
    assert store.read(BATCHES).filter("status = 'FAILED'").count() == 1 and reg.mark("raw", "people") == "2024-02-28"


def test_late_undated_and_out_of_order_files_are_read_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    reg, land = Registry(store), tmp_path / "landing"
    ids = lambda: sorted(r["id"] for r in store.read("raw/people").collect())
    put(land / "people 2024-02-05.csv", "id,name,amount\n1,x,2\n")
    ingest(store, reg, C, str(land), "2024-02-10")
    put(land / "people 2024-01-05.csv", "id,name,amount\n2,y,2\n")
    put(land / "initial%20.csv", "id,name,amount\n3,z,2\n")
    assert ingest(store, reg, C, str(land), "2024-02-11") == "SUCCEEDED" and ids() == ["1", "2", "3"]
    put(land / "people_2024-01-07.csv", "id,name,amount\n4,v,2\n")
    put(land / "people_2024-02-20.csv", "id,name,amount\n5,w,2\n")
    assert ingest(store, reg, C, str(land), "2024-01-31") == "SUCCEEDED" and ids() == ["1", "2", "3", "4"]
    assert reg.mark("raw", "people") == "2024-02-11"
    assert ingest(store, reg, C, str(land), "2024-02-11", force=True) == "SUCCEEDED" and ids() == ["1", "2", "3", "4"]
    assert ingest(store, reg, C, str(land), "2024-02-28") == "SUCCEEDED" and ids() == ["1", "2", "3", "4", "5"]


def test_store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1), (None, "n", 2)], "k int, v string, w int")
    assert not s.exists("t") and s.read_or_empty("t", df).count() == 0
    with pytest.raises(FileNotFoundError):
        s.read("t")
    with pytest.raises(ValueError):
        s.read("../t")
    s.overwrite("t", df)
    s.upsert("t", spark.createDataFrame([(2, "B", 5), (3, "c", 5), (None, "N", 9)], df.schema), ["k"])
    assert sorted((str(r["k"]), r["v"]) for r in s.read("t").collect()) == [("1", "a"), ("2", "B"), ("3", "c"), ("None", "N")]
    s.insert_new("t", spark.createDataFrame([(2, "no", 5), (4, "d", 5)], df.schema), ["k"])
    s.merge("t", spark.createDataFrame([(1, "A", 7), (2, "x", 7)], df.schema), ["k"], ["w"])
    assert sorted((str(r["k"]), r["v"], r["w"]) for r in s.read("t").collect()) == [("1", "a", 7), ("2", "B", 7), ("3", "c", 5), ("4", "d", 5), ("None", "N", 9)]
    assert sorted(r["v"] for r in s.read("t", 1).collect()) == ["a", "b", "n"]
    s.overwrite("t", s.read("t").select("k"))  # reads itself, other schema
    assert s.read("t").columns == ["k"] and s.versions("t") == [1, 2, 3, 4, 5]
    assert s.vacuum("t", keep=2) == [1, 2, 3] and s.row_count("t") == 5 and s.row_count("none") == 0
    assert s.register_views(["t", "none"]) == ["none"] and spark.table("t").count() == 5
    s.append("u", df)
    s.append("u", df.limit(0))
    s.append("u", df.select("v", F.lit("7").alias("k"), F.lit(1.5).alias("more")))  # lacks a column, adds one, other type
    assert s.read("u").count() == 6 and s.read("u").dtypes == [("k", "int"), ("v", "string"), ("w", "int"), ("more", "double")]
    assert s.register_table("u", "quarry") and spark.table("quarry.u").count() == 6


def test_store_writes_only_what_a_change_touches(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.concat(F.lit("p q/"), (F.col("id") % 10).cast("string"))).alias("p"), F.lit(0).alias("v"))
    s.overwrite("t", df.repartition(1), partition_by=["p"])
    files = lambda v=None: {r["f"] for r in s.read("t", v).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    first = files()
    assert len(first) == 10 and s.file_count("t") == 10
    s.append("t", df.filter("id < 5").withColumn("v", F.lit(1)))
    assert first < files() and s.read("t").filter("p is null").count() == 11
    s.replace_where("t", df.filter("p = 'p q/3'").withColumn("v", F.lit(2)), F.col("p") == "p q/3")
    assert len(first - files()) == 1 and s.read("t").filter("p = 'p q/3'").agg(F.count("*"), F.min("v")).first()[:] == (10, 2)
    s.merge("t", spark.createDataFrame([(20, None, 9), (200, "new", 9)], df.schema), ["id"], ["v"])
    assert len(first - files()) == 2 and s.row_count("t") == 105 and {r["id"] for r in s.read("t").filter("v = 9").collect()} == {20, 200}
    s.replace_where("t", df.limit(0), F.col("id") == 200)
    s.compact("t")
    assert s.row_count("t") == 104 and s.file_count("t") < s.file_count("t", 5)
    assert s.read("t", 1).count() == 100 and s.vacuum("t", 1) == [1, 2, 3, 4, 5] and s.row_count("t") == 104
    gone = s._write("t", df, ["p"])  # a write that failed before its commit
    s.vacuum("t", 1)
    assert s._files("t", gone) == [] and s.row_count("t") == 104
    with pytest.raises(ConcurrentWrite):
        m = s._manifest("t")
        s.append("t", df)
        s._commit("t", m, {}, df.schema, [])
    s.overwrite("e", df.limit(0), partition_by=["p"])
    s.upsert("e", df, ["id"])
    assert s.row_count("e") == 100


def test_self_check(spark, tmp_path):
    assert all(self_check(spark, str(tmp_path)).values()) and not list(tmp_path.glob("*"))


def test_sinks(spark, tmp_path):
    assert plain(float("nan")) is None and plain(float("inf")) is None
    paths = write_panels(str(tmp_path), panels(spark, "/root/testdata/sf0.001"), {"run": "r1"})
    assert len(paths) == 6 and json.loads(open(paths[0]).read())["provenance"] == {"run": "r1"}
    df = spark.createDataFrame([("a|b", None)], "x string, y int")
    assert markdown(df).splitlines()[2] == "| a\\|b |  |"
    with pytest.raises(ValueError):
        write_panels(str(tmp_path), {"x": {"q": spark.range(2000).toDF("i")}}, {})


def test_stream_reads_each_file_once(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "id,name,amount\n1,x,2\n2,y,2\n")
    args = (spark, C, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert arrive(*args) == 2 and arrive(*args) == 0
    put(tmp_path / "in" / "b.csv", "id,name,amount\n3,z,2\n")
    assert arrive(*args) == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_windowed_counts(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = windowed_counts(e, "ts", "event_type", "1 day")
    assert got.agg(F.sum("n")).first()[0] == e.count()
