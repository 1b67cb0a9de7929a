"""Runs a registered query and its SQL text side by side."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return (str(type(v)), v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("n", "nan")
        return ("n", float(repr(float(f"{v:.12g}"))))
    if isinstance(v, int):
        return ("n", float(v))
    return ("s", str(v))


def _family(t: str) -> str:
    t = t.lower()
    for name, words in {
        "int": ("bigint", "integer", "int", "hugeint", "smallint", "tinyint"),
        "float": ("double", "float", "decimal"),
        "bool": ("boolean",),
        "text": ("varchar", "string"),
    }.items():
        if any(t.startswith(w) for w in words):
            return name
    return t


def mismatch(spark_df, con, sql: str) -> str | None:
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if names != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {names}"
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    mine = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    odd = {c: (mine[c], types[c]) for c in names if _family(mine[c]) != _family(types[c])}
    if odd:
        return f"types {odd}"
    wide = {c: (mine[c], types[c]) for c in names if (mine[c] == "bigint") != (types[c] == "BIGINT")
            and _family(types[c]) == "int"}
    if wide:
        return f"int width {wide}"
    a = sorted((tuple(_cell(r[c]) for c in names) for r in spark_df.collect()), key=str)
    order = [rel.columns.index(c) for c in names]
    b = sorted((tuple(_cell(r[i]) for i in order) for r in rel.fetchall()), key=str)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} rows differ, e.g. {diff[:2]}" if diff else None


def main(sf_dir: str, only: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from clicktide.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in only or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = mismatch(df, con, oracles[name]) if name in oracles else None
            note = "" if name in oracles else f"(rows only: {df.count()})"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem, note = f"{type(e).__name__}: {str(e)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {time.time() - t0:6.2f}s {note} {problem or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
