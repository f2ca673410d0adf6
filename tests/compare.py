"""Runs a catalog query and its SQL on the same tables and compares the two row bags."""

import glob
import os
from collections import Counter

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(spark, con, query, sql, sf_dir):
    """Human-readable differences; empty if names, types and rows agree."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    relation = con.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    found = []
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in frame.dtypes:
        if TYPES.get(kind) != expected_types[name]:
            found.append(f"type of {name}: {kind} != {expected_types[name]}")
    ours = Counter(tuple(row) for row in frame.select([f"`{n}`" for n in names]).collect())
    listed = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(relation.project(listed).fetchall())
    if ours != theirs:
        found.append(f"rows {ours.total()} != {theirs.total()}")
        found += [f"only spark: {row}" for row in list((ours - theirs))[:2]]
        found += [f"only sql:   {row}" for row in list((theirs - ours))[:2]]
    return found
