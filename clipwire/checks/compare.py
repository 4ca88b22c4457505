"""Run registered queries beside their SQL twins: python -m clipwire.checks.compare [sf] [names]."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from clipwire.checks.oracle import oracles
from clipwire.checks.registry import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _round(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the query and its twin: columns, types or rows; None if nothing."""
    df = registered()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(_round(r) for r in df.select(*columns).collect())
    rel = con.sql(oracles()[name])
    if sorted(rel.columns) != columns:
        return f"columns {columns} / {sorted(rel.columns)}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    wrong = [c for c, t in df.dtypes if _TYPES.get(t) != types[c]]
    if wrong:
        return f"types {[(c, dict(df.dtypes)[c], types[c]) for c in wrong]}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(_round(r) for r in rel.project(quoted).fetchall())
    if ours != theirs:
        return (
            f"rows {sum(ours.values())} / {sum(theirs.values())}, "
            f"only ours {str(list((ours - theirs).items())[:2])[:600]}, "
            f"only theirs {str(list((theirs - ours).items())[:2])[:600]}"
        )
    if not ours:
        return "no rows"
    return None


def main() -> None:
    from clipwire.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(registered())
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as problem:
            found = f"{type(problem).__name__}: {str(problem)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'same'}", flush=True)


if __name__ == "__main__":
    main()
