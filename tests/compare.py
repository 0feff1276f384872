"""Compare a Spark result with a DuckDB one: names, row count and values, in any row order."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(spark, connection, query, sql, folder) -> list[str]:
    began = time.time()
    df = query(spark, folder)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    middle = time.time()
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    print(f"  spark {middle - began:.2f} s, sql {time.time() - middle:.2f} s, {len(ours[1])} rows")
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} against {theirs[0]}"]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    wrong = [f"{n}: {k} against {kinds[n]}" for n, k in df.dtypes if KINDS.get(k) != kinds[n]]
    if wrong:
        return wrong
    if len(ours[1]) != len(theirs[1]):
        return [f"{len(ours[1])} rows against {len(theirs[1])}"]
    return [f"{a} against {b}" for a, b in zip(ours[1], theirs[1], strict=True) if a != b][:5]


def main(folder: str, *chosen: str) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from ridgeworks.session import build_session

    spark = build_session(master="local[8]", spark_sql_shuffle_partitions=8, spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = []
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        sql = entry.oracle_sql().get(name)
        print(name, flush=True)
        try:
            if sql is None:
                print(f"  {query(spark, folder).count()} rows, no SQL")
                continue
            found = differences(spark, connection, query, sql, folder)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        if found:
            bad.append(name)
            print("  DIFFERENT", *found, sep="\n    ")
    print("different:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
