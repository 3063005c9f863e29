"""Run registered queries next to their SQL in DuckDB and compare every value."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    if isinstance(value, float):
        return repr(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between both results; empty when they agree."""
    frame = query(spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(set(names) ^ set(frame.columns))}"]
    problems = [f"spark only x{n}: {row}" for row, n in (ours - theirs).items()]
    problems += [f"sql only x{n}: {row}" for row, n in (theirs - ours).items()]
    if not ours:
        problems.append("no rows")
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as driver

    from forgelens.session import build_session

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = duck(sf_dir), driver.oracle_sql(), 0
    for name, query in driver.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, connection, query, oracles[name], sf_dir)
            else:
                problems = [] if query(spark, sf_dir).collect() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        kind = "ok" if name in oracles else "ok (no sql)"
        print(f"{name}: {'FAIL' if problems else kind} {time.time() - start:.1f}s", flush=True)
        for line in problems[:6]:
            print("   ", line[:900])
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
