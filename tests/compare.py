"""Run registered queries next to their SQL in DuckDB and compare every value.

python -m tests.compare [prefix ...]   (scale folder in TEST_SF_DIR)
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"d{value.normalize()}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return f"t{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return f"s{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows), sorted(columns)


_KIND = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "double": "double",
    "string": "string", "boolean": "bool", "date": "date32[day]",
}


def kinds_differ(spark_schema, arrow_schema) -> list[str]:
    arrow = {f.name: str(f.type) for f in arrow_schema}
    out = []
    for f in spark_schema:
        want, got = _KIND.get(f.dataType.simpleString()), arrow.get(f.name)
        if want and want != got:
            out.append(f"{f.name}: {want} vs {got}")
    return out


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return (len(got) > 0, f"{len(got)} rows, no SQL")
    relation = con.sql(sql)
    table = relation.to_arrow_table()
    want, wcols = rows_of(relation.columns, con.sql(sql).fetchall())
    if cols != wcols:
        return False, f"columns {cols} vs {wcols}"
    kinds = kinds_differ(df.schema, table.schema)
    if kinds:
        return False, f"types {kinds}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return False, f"{len(got)} vs {len(want)} rows; first differing {diff}"
    return len(got) > 0, f"{len(got)} rows equal"


def main(prefixes):
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import local_session

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    spark, con, oracle, failed = local_session(8), duck(sf_dir), oracle_sql(), []
    selected = {
        n: f for n, f in queries().items() if not prefixes or any(n.startswith(p) for p in prefixes)
    }
    for name, fn in selected.items():
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as exc:
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:700]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{len(selected) - len(failed)} of {len(selected)} good; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
