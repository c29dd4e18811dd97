"""Comparison of a query with its SQL in DuckDB: python -m tests.compare [FOLDER] [NAME...]."""

import math
import sys
import time
from pathlib import Path

import duckdb


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T00:00:00", "")
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def duck(folder):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        src = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"create view {p.stem} as select * from read_parquet('{src}')")
    return con


def compare(spark, con, folder, query, sql):
    """'' if equal, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} rows against {len(want)}; only here {list(a - b)[:3]}; only in SQL {list(b - a)[:3]}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from quarrylake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, oracle = local_session(8), duck(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            said = compare(spark, con, folder, query, oracle[name]) if name in oracle else f"rows only: {query(spark, folder).count()}"
        except Exception as e:
            said = f"ERROR {str(e)[:600]}"
        print(f"{name}: {said or 'equal'} ({time.time() - t:.1f} s)", flush=True)
