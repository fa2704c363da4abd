"""Run a query and its SQL on the same files and compare schema and values."""

import math

import duckdb

from vintagewise.catalog.views import TABLES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "float": "FLOAT"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(rows, order):
    return sorted("|".join(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when they agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        expected = TYPES.get(field.dataType.simpleString())
        if types[field.name] != expected:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}")
    ordered = sorted(names)
    theirs = _rows(result.fetchall(), [names.index(n) for n in ordered])
    ours = _rows(df.collect(), [df.columns.index(n) for n in ordered])
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    if ours != theirs:
        left, right = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
        problems.append(f"{len(left)} differing rows, columns {ordered}\n  ours {left[:2]}\n  sql  {right[:2]}")
    return problems
