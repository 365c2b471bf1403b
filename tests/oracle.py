"""Compare a query with its SQL, run by DuckDB on the same files."""

import glob
import math
import os

import duckdb

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql):
    """Empty list if names, types and rows are equal; else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = _canonical(names, result.fetchall())
    got = _canonical(frame.columns, [tuple(r) for r in frame.collect()])
    found = []
    ours = {n: KINDS.get(t, t) for n, t in frame.dtypes}
    if ours != kinds:
        found.append(("types", {n: (ours.get(n), kinds.get(n)) for n in {*ours, *kinds} if ours.get(n) != kinds.get(n)}))
    if len(expected) != len(got):
        found.append(("count", len(got), len(expected)))
    if expected != got:
        sample = [(g, e) for g, e in zip(got, expected) if g != e][:3]
        found.append(("rows", sample))
    return found
