"""Run registered queries beside their SQL twins and print what differs.

    python tests/check_oracles.py [folder] [name-part ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from broadloom.queries import oracles, registered  # noqa: E402
from broadloom.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)) and not isinstance(value, str):
        return [plain(v) for v in value]
    if hasattr(value, "asDict"):
        return plain(list(value.asDict().values()))
    if isinstance(value, dict):
        return plain(list(value.values()))
    return value


def compare(spark, connection, name, fn, sql, folder):
    frame = fn(spark, folder)
    names = sorted(frame.columns)
    ours = [tuple(repr(plain(row[c])) for c in names) for row in frame.collect()]
    if sql is None:
        return f"rows only: {len(ours)}" if ours else "EMPTY"
    result = connection.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"FAIL columns {names} vs {sorted(theirs_names)}"
    place = [theirs_names.index(c) for c in names]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = [tuple(repr(plain(row[i])) for i in place) for row in result.fetchall()]
    ours.sort(), theirs.sort()
    if ours != theirs:
        extra = sorted(set(ours) - set(theirs))[:2]
        lacking = sorted(set(theirs) - set(ours))[:2]
        return f"FAIL {len(ours)} vs {len(theirs)} rows\n  ours  {extra}\n  oracle {lacking}"
    spark_types = dict(frame.dtypes)
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}
    odd = [f"{c}: {spark_types[c]}/{types[c]}" for c in names if pairs.get(spark_types[c], types[c]) != types[c]]
    note = f" TYPES {odd}" if odd else ""
    return f"ok {len(ours)} rows{note}" if ours else "ok but EMPTY"


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    sqls, bad = oracles(), 0
    for name, fn in registered().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            verdict = compare(spark, connection, name, fn, sqls.get(name), folder)
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += verdict.startswith(("FAIL", "ERROR", "EMPTY"))
        print(f"{name:34s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
