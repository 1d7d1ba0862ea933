"""Row-by-row comparison of a Spark result with DuckDB's answer to the paired SQL."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    expected = con.sql(sql)
    if sorted(df.columns) != sorted(expected.columns):
        return f"columns {sorted(df.columns)} != {sorted(expected.columns)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(expected.columns, expected.fetchall())
    if got == want:
        return None
    a, b = set(got), set(want)
    return (
        f"{len(got)} vs {len(want)} rows; only Spark {list(a - b)[:2]}; only SQL {list(b - a)[:2]}"
    )


def loose_type(name):
    """Engine-independent type family."""
    name = name.lower()
    for family, words in {
        "int": ("bigint", "int", "integer", "smallint"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if name in words:
            return family
    return name
