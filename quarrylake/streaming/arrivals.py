"""Files as they arrive: the raw archive fed by a stream that stops when there is nothing more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import Contract
from ..sources.ingest import CORRUPT


def arrive(spark: SparkSession, contract: Contract, folder: str, out: str, checkpoint: str, files_a_trigger: int = 1000) -> int:
    """Appends all files that are new since the last call to Parquet at `out`, each once, and returns the number of rows.

    The stream's checkpoint says what has been read, so a call after a failure goes on where it stopped. The checkpoint must
    lie in a folder that all executors share.
    """
    reader = spark.readStream.schema(contract.raw_schema(CORRUPT)).option("columnNameOfCorruptRecord", CORRUPT).option("maxFilesPerTrigger", files_a_trigger)
    rows = reader.option("header", True).csv(folder) if contract.format == "csv" else reader.json(folder)
    rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingestion_ts"))
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    rows_of: dict[int, int] = {}
    done = False
    while not done:  # only the latest progress is kept by the query, so it is noted as it comes
        done = query.awaitTermination(1)
        rows_of |= {int(p["batchId"]): int(p["numInputRows"]) for p in query.recentProgress}
    return sum(rows_of.values())


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, kind, n) by event time; on a stream, windows close `late` after the latest event and later rows are dropped."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return events.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
