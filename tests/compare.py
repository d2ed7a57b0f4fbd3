"""Run queries and their SQL side by side: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL answer; empty when they are equal."""
    cols, got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_cols, want = normal(names, cur.fetchall())
    if cols != want_cols:
        return [f"columns {cols} <> {want_cols}"]
    out = [] if len(got) == len(want) else [f"rows {len(got)} <> {len(want)}"]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {cols}\n   {bad[0][0]}\n   {bad[0][1]}")
    kinds = [type(v) for v in next(iter(got), ())], [type(v) for v in next(iter(want), ())]
    if not bad and kinds[0] != kinds[1]:
        out.append(f"types {kinds}")
    return out


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf, names = (sys.argv[1:2] or ["0.01"])[0], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con, sqls, failed = connect(folder), oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in sqls:
                found = differences(df, con, sqls[name])
                n = "" if found else con.execute(f"SELECT COUNT(*) FROM ({sqls[name]})").fetchall()[0][0]
            else:
                found, n = [], f"{df.count()} rows only"
        except Exception as exc:  # noqa: BLE001
            found, n = [f"{type(exc).__name__}: {str(exc)[:1500]}"], ""
        failed += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {n} {time.time() - start:.1f}s", *found, sep="\n  " if found else " ", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
