"""Run registered queries next to their SQL and report differences.

``python -m harness.compare [--large] [sf or folder] [names...]``; ``--large`` makes every size check answer "too big", so
that joins shuffle or salt and keys are numbered range by range, as they would on large tables.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from harness.oracles import ORACLES
from harness.queries import QUERIES
from tallyloft.operators import joins, keys
from tallyloft.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bytes, bytearray)):
        return value.hex()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows) if all(
        None not in r for r in rows) else sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if v is None else v for v in t))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    spark.sparkContext.setJobGroup(name, name)
    df = QUERIES[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if name not in ORACLES:
        return True, f"{len(mine)} rows, no SQL, {took:.1f}s"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    if a == b:
        types = {n: str(t) for n, t in zip(names, [d[1] for d in result.description])}
        return True, f"{len(a)} rows, {took:.1f}s  {pairs(df, types)}"
    only_a, only_b = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
    return False, f"{len(a)} vs {len(b)} rows; {sorted(df.columns)}\n   spark {only_a}\n   sql   {only_b}"


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP"}


def pairs(df, types: dict[str, str]) -> str:
    odd = [f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in df.schema.fields
           if KINDS.get(f.dataType.simpleString()) != types[f.name]]
    return "types differ: " + ", ".join(odd) if odd else ""


def pretend_large() -> None:
    joins.BROADCAST_ROWS = keys.ONE_TASK_ROWS = 0


def main(argv: list[str]) -> int:
    if "--large" in argv:
        argv = [a for a in argv if a != "--large"]
        pretend_large()
    sf = argv[0] if argv else "0.01"
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    names = argv[1:] or list(QUERIES)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    if joins.BROADCAST_ROWS == 0:
        settings["spark.sql.autoBroadcastJoinThreshold"] = "10000"
    if log := os.environ.get("COMPARE_EVENT_LOG"):
        settings |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.compress": "false",
                     "spark.eventLog.rolling.enabled": "false",
                     # Small partitions stay apart, so that an uneven one can be seen.
                     "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    spark = build_session("compare", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(sf_dir), 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
