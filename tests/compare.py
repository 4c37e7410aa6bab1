"""Runs a named query and its oracle and reports the first difference."""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return float(value)
    if isinstance(value, bool) or not isinstance(value, int):
        return value if isinstance(value, (bool, int)) else str(value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, connection, name, entry, sf_dir):
    """None when equal, else a description."""
    df = entry.run(spark, sf_dir)
    columns, rows = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    if entry.sql is None:
        return None if rows else "no rows"
    result = connection.execute(entry.sql)
    names = [d[0] for d in result.description]
    wanted_columns, wanted = sorted_rows(names, result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    for mine, theirs in zip(rows, wanted):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{columns}\n  spark  {mine}\n  oracle {theirs}"
    return None if rows else "no rows on either side"


def main(sf_dir, only):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from catalog import all_queries
    from hazeline.session import local_session

    spark, connection, failed = local_session(), connect(sf_dir), []
    for name, entry in all_queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, name, entry, sf_dir)
        except Exception as error:  # reported, and the run goes on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name}"
              f"{'' if entry.sql else ' (rows)'}{'' if problem is None else ': ' + problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
