"""Compare registered queries with their SQL: ``python tests/oracle.py [folder] [names...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def differences(spark, con, name: str, run, sql: str, folder: str) -> list[str]:
    """What differs between the two results, empty when nothing does."""
    frame = run(spark, folder)
    names = sorted(frame.columns)
    mine = sorted((tuple(r) for r in frame.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    found = []
    if sorted(described) != names:
        return [f"columns {names} and {sorted(described)}"]
    positions = [list(described).index(n) for n in names]
    theirs = sorted((tuple(r[p] for p in positions) for r in rows), key=_key)
    for field in frame.schema.fields:
        kind = field.dataType.simpleString()
        if TYPES.get(kind) != described[field.name].upper():
            found.append(f"type of {field.name}: {kind} and {described[field.name]}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} and {len(theirs)}")
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0][0]} and {different[0][1]}")
    if not mine:
        found.append("no rows")
    return found


def main() -> int:
    from brightmere.plans import QUERIES, SQL
    from brightmere.session import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                    spark__ui__showConsoleProgress="false",
                    spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            if name in SQL:
                found = differences(spark, con, name, QUERIES[name], SQL[name], folder)
            else:
                rows = QUERIES[name](spark, folder).count()
                found = [] if rows else ["no rows"]
        except Exception as error:
            found = [str(error).split("\n\nJVM stacktrace")[0][:1500]]
            if "-v" in os.environ.get("ORACLE", ""):
                traceback.print_exc()
        bad += bool(found)
        kind = "sql " if name in SQL else "rows"
        print(f"{'BAD ' if found else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {'; '.join(found)}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
