"""Run a query and its oracle side by side; also usable from the command line: parity.py [sf] [name...]."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, str)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        raise TypeError(f"decimal in a checked result: {value}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    raise TypeError(f"unexpected {type(value)} in a checked result")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(cell(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=4")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got_names == want_names, f"columns {got_names} != {want_names}"
    for value in got - want:
        assert False, (
            f"{sum((got - want).values())} rows only in Spark of {sum(got.values())}, "
            f"{sum((want - got).values())} only in SQL of {sum(want.values())}: {value} vs {next(iter(want - got), None)}"
        )
    assert not want - got, f"{sum((want - got).values())} rows only in SQL, e.g. {next(iter(want - got))}"
    return sum(got.values())


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("signwatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main():
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                n = compare(spark, con, sf_dir, queries[name], oracles[name])
                state = "ok  " if n else "EMPTY"
            else:
                n = len(queries[name](spark, sf_dir).collect())
                state = "rows" if n else "EMPTY"
            if state == "EMPTY":
                bad.append(name)
            print(f"{state} {name} {n} rows {time.time() - start:.2f}s", flush=True)
        except Exception as error:
            bad.append(name)
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:700]}", flush=True)
    print(f"{len(names or queries)} checked, bad: {bad}")


if __name__ == "__main__":
    main()
