"""Run registered queries and compare them with their check SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from __spark_entry__ import oracle_sql, queries
from modelyard.session import local_session
from modelyard.sources.tables import NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, list):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return repr(v)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = queries()[name](spark, sf_dir)
    names, mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return len(mine) > 0, f"rows only: {len(mine)} in {took:.1f}s"
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    kinds = {c[0]: str(c[1]) for c in rel.description}
    started = time.time()
    theirs_names, theirs = canonical(cols, rel.fetchall())
    duck = time.time() - started
    if names != theirs_names:
        return False, f"columns {names} vs {theirs_names}"
    if mine != theirs:
        only_a = [r for r in mine if r not in set(theirs)][:3]
        only_b = [r for r in theirs if r not in set(mine)][:3]
        return False, f"{len(mine)} vs {len(theirs)} rows\n   spark {only_a}\n   duck  {only_b}"
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return True, f"{len(mine)} rows, {took:.1f}s / {duck:.1f}s  " + ", ".join(
        f"{n}:{spark_kinds[n]}/{kinds[n]}" for n in names if _family(spark_kinds[n]) != _family(kinds[n])
    )


def _family(kind: str) -> str:
    kind = kind.lower()
    return {"varchar": "string", "integer": "int"}.get(kind, kind)


def main() -> None:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as err:  # report and go on with the next query
            ok, note = False, f"{type(err).__name__}: {str(err)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
