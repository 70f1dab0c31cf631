"""Run registered queries against their SQL: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None where both results have the same typed columns and are the same multiset of rows."""
    df = query(spark, sf_dir)
    got_types = {f.name: KINDS.get(f.dataType.simpleString()) for f in df.schema.fields}
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    got_cols, got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, query, oracles[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              f"{'' if name in oracles else ' (rows only)'} {problem or ''}", flush=True)
    print(f"{bad} problems; oracles without query: {set(oracles) - set(contract.queries())}")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
