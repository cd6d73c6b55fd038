"""Compare registered queries with their SQL in DuckDB: same columns, same rows, same values."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def kind(value: object) -> str:
    return "number" if isinstance(value, (int, float)) and not isinstance(value, bool) else type(value).__name__


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> str:
    """Empty text if equal, else what differs."""
    df = run(spark, sf_dir)
    left_cols = sorted(df.columns)
    left = [tuple(plain(r[c]) for c in left_cols) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    right_cols = [names[i] for i in order]
    right = [tuple(plain(r[i]) for i in order) for r in result.fetchall()]
    if left_cols != right_cols:
        return f"columns {left_cols} vs {right_cols}"
    a, b = Counter(left), Counter(right)
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return f"rows {len(left)} vs {len(right)}; {len(only_a)} differ\n  {left_cols}\n  spark {sorted(map(str, only_a))[:2]}\n  sql   {sorted(map(str, only_b))[:2]}"


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from tallywatch.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            outcome = compare(spark, con, name, run, oracles[name], sf_dir) if name in oracles else "no sql"
        except Exception as e:  # a report, not a test
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(outcome)
        print(f"{'ok  ' if not outcome else 'BAD '} {name} {time.time() - start:.1f}s {outcome}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
