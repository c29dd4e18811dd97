"""Small results as JSON panels and Markdown."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

#: Most rows of a panel: a panel is a report, and a larger result is an error and not cut.
PANEL_ROWS = 1_000


def plain(v):
    """JSON value: NaN and infinities are null, dates ISO, decimals numbers of six digits."""
    if isinstance(v, float):
        return None if math.isnan(v) or math.isinf(v) else v
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows_of(df: DataFrame) -> list[dict]:
    rows = df.limit(PANEL_ROWS + 1).collect()
    if len(rows) > PANEL_ROWS:
        raise ValueError(f"a panel has at most {PANEL_ROWS} rows")
    return [{k: plain(v) for k, v in r.asDict().items()} for r in rows]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text to a path of any file system that Spark knows, in place of what is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(text.encode())
    out.close()


def write_panels(folder: str, panels: Mapping[str, Mapping[str, DataFrame]], stamp: Mapping[str, str]) -> list[str]:
    """One compact JSON file per panel with its queries' rows and the stamp, in a folder of any file system; returns the paths."""
    out = []
    for name, parts in panels.items():
        path = f"{folder.rstrip('/')}/{name}.json"
        told = json.dumps({"provenance": dict(stamp), **{k: rows_of(df) for k, df in parts.items()}}, separators=(",", ":"), allow_nan=False, ensure_ascii=False)
        write_text(next(iter(parts.values())).sparkSession, path, told)
        out.append(path)
    return out


def markdown(df: DataFrame) -> str:
    """The rows as a Markdown table."""
    rows = rows_of(df)
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *[line(r.values()) for r in rows]])
