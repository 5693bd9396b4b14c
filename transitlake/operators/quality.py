"""Data-quality operators T1-T4 -> one DataFrame (table_name, column_name, check_name,
failing_rows).

* not_null / accepted_values: one aggregation pass per table (map-side partial
  sums, a single row shuffled), however many columns are checked.
* unique: groupBy(key) count > 1, partial aggregation absorbs hot keys.
* foreign key: child `left_anti` parent on the key; Spark broadcasts a parent of few
  bytes, otherwise it is a shuffled anti join (AQE splits skew).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


RESULT_COLUMNS = ["table_name", "column_name", "check_name", "failing_rows"]


def _rows(df: DataFrame, table: str, named_counts: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregation computing all counts, unpivoted to result rows."""
    agg = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"c{i}")
                   for i, (_, _, c) in enumerate(named_counts)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                 F.lit(chk).alias("check_name"), F.col(f"c{i}").alias("failing_rows"))
        for i, (col, chk, _) in enumerate(named_counts)]))
    return agg.select(stack.alias("r")).select("r.*")


def _null_count(column: str) -> tuple[str, str, Column]:
    """Rows where the column is NULL."""
    return column, "not_null", F.sum(F.col(column).isNull().cast("int"))


def _unaccepted_count(column: str, values: Sequence) -> tuple[str, str, Column]:
    """Non-NULL values outside the accepted set (NULL passes)."""
    return column, "accepted_values", F.sum((F.col(column).isNotNull() & ~F.col(column).isin(list(values))).cast("int"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _rows(df, table, [_null_count(c) for c in columns])


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence) -> DataFrame:
    return _rows(df, table, [_unaccepted_count(column, values)])


def unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*columns).count().filter(F.col("count") > 1)
    return _rows(dup, table, [(",".join(columns), "unique", F.count(F.lit(1)))])


def foreign_key(child: DataFrame, table: str, child_cols: Sequence[str], parent: DataFrame,
                parent_cols: Sequence[str], parent_name: str) -> DataFrame:
    """T4: child rows with a non-NULL key that has no parent row."""
    keys = parent.select(*[F.col(p).alias(f"__k{i}") for i, p in enumerate(parent_cols)]).distinct()
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k{i}") for i, c in enumerate(child_cols)])
    orphans = child.select(*child_cols).filter(nonnull).join(keys, cond, "left_anti")
    return _rows(orphans, table, [(",".join(child_cols), f"references {parent_name}",
                                   F.count(F.lit(1)))])


@dataclass
class QualitySpec:
    not_null: dict[str, list[str]] = field(default_factory=dict)
    accepted: list[tuple[str, str, list]] = field(default_factory=list)
    unique: list[tuple[str, list[str]]] = field(default_factory=list)
    foreign: list[tuple[str, list[str], str, list[str]]] = field(default_factory=list)


def run_checks(tables: dict[str, DataFrame], spec: QualitySpec) -> DataFrame:
    parts: list[DataFrame] = []
    # T1 and T2 of a table are counted in one pass over it
    for t in dict.fromkeys([*spec.not_null, *[a[0] for a in spec.accepted]]):
        counts = [_null_count(c) for c in spec.not_null.get(t, [])]
        counts += [_unaccepted_count(c, vals) for name, c, vals in spec.accepted if name == t]
        parts.append(_rows(tables[t], t, counts))
    for t, cols in spec.unique:
        parts.append(unique(tables[t], t, cols))
    for t, cols, p, pcols in spec.foreign:
        parts.append(foreign_key(tables[t], t, cols, tables[p], pcols, p))
    return reduce(DataFrame.unionByName, parts)
