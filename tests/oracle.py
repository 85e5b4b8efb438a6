"""Runs queries beside their SQL, as the driver does: columns by name, rows in any order."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[str]]:
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at + '/*.parquet' if os.path.isdir(at) else at}'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return _rows(names, [dict(zip(names, r, strict=True)) for r in got.fetchall()])


def _rows(names: list[str], rows: list[dict]) -> tuple[list[str], list[str]]:
    names = sorted(names)
    return names, sorted(repr(tuple(r[n] for n in names)) for r in rows)


def spark_rows(df) -> tuple[list[str], list[str]]:
    return _rows(df.columns, [r.asDict(recursive=True) for r in df.collect()])
