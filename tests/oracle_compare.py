"""Run a registered query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = ("events", "customer", "nation", "region")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# DuckDB and Spark names of the same types
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def differences(df, sql: str, con) -> list[str]:
    """What differs, as text; empty if columns, types and all values are equal."""
    cursor = con.execute(sql)
    oracle_columns = [d[0] for d in cursor.description]
    oracle_types = {d[0]: _TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    oracle_rows = _rows(oracle_columns, cursor.fetchall())
    spark_types = dict(df.dtypes)
    spark_rows = _rows(df.columns, df.collect())
    found = []
    if sorted(df.columns) != sorted(oracle_columns):
        return [f"columns {sorted(df.columns)} != {sorted(oracle_columns)}"]
    for name in df.columns:
        if spark_types[name] != oracle_types[name]:
            found.append(f"type of {name}: {spark_types[name]} != {oracle_types[name]}")
    if len(spark_rows) != len(oracle_rows):
        found.append(f"{len(spark_rows)} rows != {len(oracle_rows)}")
    only_spark, only_oracle = set(spark_rows) - set(oracle_rows), set(oracle_rows) - set(spark_rows)
    if only_spark or only_oracle:
        found.append(f"spark only {len(only_spark)}: {sorted(only_spark)[:3]}; oracle only {len(only_oracle)}: {sorted(only_oracle)[:3]}")
    elif spark_rows != oracle_rows:
        found.append("same distinct rows, different multiplicity")
    if not oracle_rows:
        found.append("no rows at all")
    return found
