"""Compare catalog queries with their SQL twins: ``python tests/check.py SF_DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(x):
    if isinstance(x, datetime):
        return x.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    return "" if x is None else f"{type(x).__name__}:{x}"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, db, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    columns, rows = frame.columns, frame.collect()
    result = db.execute(sql)
    other = [d[0] for d in result.description]
    if sorted(columns) != sorted(other):
        return f"columns {sorted(columns)} != {sorted(other)}"
    a, b = rows_of(columns, rows), rows_of(other, result.fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    import __spark_entry__ as contract
    from fluxwell.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, db, sqls = local_session(), connect(sf_dir), contract.oracle_sql()
    queries = contract.queries()
    print("without SQL:", sorted(set(queries) - set(sqls)), "without query:", sorted(set(sqls) - set(queries)))
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(query(spark, sf_dir), db, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        print(f"{name:24s} {time.time() - start:6.2f}s {'ok' if problem is None else problem[:900]}", flush=True)


if __name__ == "__main__":
    main()
