"""Compare every registered query with its SQL on DuckDB.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return float(round(value, 6))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(made, key=repr)


def compare(frame, con, text):
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(text)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(set(frame.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}; " + first_difference(mine, theirs)
    if mine != theirs:
        return first_difference(mine, theirs)
    kinds = {n: d for n, d in frame.dtypes}
    duck = {d[0]: str(d[1]) for d in result.description}
    odd = [
        (n, kinds[n], duck[n]) for n in names
        if not same_kind(kinds[n], duck[n])
    ]
    return f"types {odd}" if odd else f"ok {len(mine)}"


FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "date": "DATE",
}


def same_kind(spark_kind, duck_kind):
    if spark_kind.startswith("decimal"):
        return duck_kind.startswith("DECIMAL") and spark_kind[7:] == duck_kind[7:].replace(" ", "")
    return FAMILIES.get(spark_kind, "?") == duck_kind


def first_difference(mine, theirs):
    a, b = set(map(repr, mine)), set(map(repr, theirs))
    return f"only spark {sorted(a - b)[:3]} only sql {sorted(b - a)[:3]}"


def connection(folder):
    import duckdb

    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    failed = 0
    texts = entry.oracle_sql()
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in texts:
                verdict = compare(query(spark, folder), con, texts[name])
            else:
                verdict = f"ok (no sql) {query(spark, folder).count()}"
        except Exception as problem:  # report and go on
            verdict = f"error {type(problem).__name__} {str(problem)[:700]}"
        failed += not verdict.startswith("ok")
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
