"""Batches and high-water marks: what has been done, and how far."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from .store import TableStore

BATCHES, MARKS = "control/batches", "control/watermarks"
_BATCH = "batch_id string, layer string, source string, logical_date string, status string, n_rows bigint, message string, started_at timestamp, ended_at timestamp"


def batch_id(logical_date: date | str, layer: str, source: str) -> str:
    """The same for a date and its ISO text, different for another date, layer or source."""
    return hashlib.sha256(f"{str(logical_date)[:10]}|{layer}|{source}".encode()).hexdigest()[:16]


class Registry:
    """Control tables in a store."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark

    def status(self, batch: str) -> str | None:
        if not self.store.exists(BATCHES):
            return None
        row = self.store.read(BATCHES).filter(F.col("batch_id") == batch).select("status").first()
        return row["status"] if row else None

    def _put(self, **v) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = {"batch_id": None, "layer": None, "source": None, "logical_date": None, "status": None, "n_rows": None, "message": None, "started_at": now, "ended_at": None} | v
        df = self.spark.createDataFrame([tuple(row.values())], _BATCH)
        # a finished batch keeps the time it began
        update = [c for c in row if c not in (("batch_id", "started_at") if v["status"] != "RUNNING" else ("batch_id",))]
        self.store.merge(BATCHES, df, ["batch_id"], update)

    def run(self, logical_date: date | str, layer: str, source: str, step: Callable[[str], int], force: bool = False) -> str:
        """Runs step(batch id) -> rows unless the batch has succeeded before. Returns SKIPPED or SUCCEEDED.

        A failure is recorded with the first 1,000 characters of its message and raised again. The mark of (layer, source) is
        moved only after success.
        """
        batch = batch_id(logical_date, layer, source)
        if not force and self.status(batch) == "SUCCEEDED":
            return "SKIPPED"
        about = {"batch_id": batch, "layer": layer, "source": source, "logical_date": str(logical_date)[:10]}
        self._put(**about, status="RUNNING")
        now = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
        try:
            n = step(batch)
        except Exception as e:
            self._put(**about, status="FAILED", message=str(e)[:1000], ended_at=now())
            raise
        self._put(**about, status="SUCCEEDED", n_rows=n, ended_at=now())
        self.advance(layer, source, logical_date)
        return "SUCCEEDED"

    def mark(self, layer: str, source: str) -> str | None:
        """Latest logical date that was done."""
        if not self.store.exists(MARKS):
            return None
        row = self.store.read(MARKS).filter((F.col("layer") == layer) & (F.col("source") == source)).first()
        return row["mark"] if row else None

    def advance(self, layer: str, source: str, logical_date: date | str) -> None:
        """Moves the mark forward, never back."""
        df = self.spark.createDataFrame([(layer, source, str(logical_date)[:10])], "layer string, source string, mark string")
        self.store.merge(MARKS, df, ["layer", "source"], ["mark"], lambda t, s: s("s.mark") > t("t.mark"))
