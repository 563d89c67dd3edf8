"""Run checks against their DuckDB oracles and report the differences."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def _bag(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """``None`` when both sides have the same columns and rows."""
    got_cols, got = _bag(df.columns, df.collect())
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    kinds = {c[0]: str(c[1]) for c in res.description}
    want_cols, want = _bag(names, res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    spark_kinds = dict(df.dtypes)
    same = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    }
    odd = [(c, spark_kinds[c], kinds[c]) for c in names if same.get(kinds[c]) != spark_kinds[c]]
    if odd:
        return f"types {odd}"
    if got != want:
        left, right = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} / {sum(want.values())}, only here {left}, only oracle {right}"
    if not want:
        return "no rows"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from checks import options, streams  # noqa: F401  register their queries
    from checks.catalog import ORACLES, QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                found = difference(df, con, ORACLES[name])
            else:
                found = None if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'BAD ' if found else 'ok  '} {name:28s} {time.time() - start:6.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} good")
    spark.stop()


if __name__ == "__main__":
    main()
