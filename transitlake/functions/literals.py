"""Helpers that turn in-code literal values into JVM-side plans.

Seed tables become `VALUES` relations (a LocalRelation: exact statistics, no
Python worker, folded by Catalyst), and long ordered CASE chains become one SQL
expression instead of dozens of client calls.
"""
from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, decimal.Decimal):
        return f"{v}BD"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def values_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A LocalRelation with the given rows, cast to `schema`."""
    names = [f.name for f in schema.fields]
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({aliases})")


def first_contains(text_sql: str, pairs, default) -> Column:
    """CASE WHEN contains(text, k1) THEN v1 ... ELSE default END as one expression."""
    arms = " ".join(f"WHEN contains({text_sql}, {sql_literal(k)}) THEN {sql_literal(v)}"
                    for k, v in pairs)
    return F.expr(f"CASE {arms} ELSE {sql_literal(default)} END")


def pick(values: list, index_sql: str) -> Column:
    """values[index] for a 0-based integer SQL expression, as one expression."""
    arr = ", ".join(sql_literal(v) for v in values)
    return F.expr(f"element_at(array({arr}), CAST(({index_sql}) + 1 AS INT))")
