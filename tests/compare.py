"""Run registered queries against DuckDB on the same parquet files."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


TIMES: dict[str, float] = {}


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (bool, int, str)):
        return value
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types by family and all values agree, otherwise what differs."""
    rows = spark_df.collect()
    TIMES["spark"] = time.time()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got, want = _sorted_rows(spark_df.columns, rows), _sorted_rows(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows, SQL gives {len(want)}; first {got[:2]} vs {want[:2]}"
    for g, w in zip(got, want):
        for x, y, name in zip(g, w, sorted(names)):
            if x != y or type(x) is not type(y):
                return f"column {name}: {x!r} != {y!r} in {g} vs {w}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import get_session

    spark = get_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = "/root/testdata/sf0.01"
    con = duck(sf_dir)
    oracles, wanted = oracle_sql(), sys.argv[1:]
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += problem is not None
        state = "ok" if problem is None else "DIFF"
        spark_seconds = TIMES.pop("spark", time.time()) - start
        print(f"{state:5}{name:32}{spark_seconds:6.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
