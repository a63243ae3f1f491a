"""Declared target contracts and their checks (SNK-7).

Parquet enforces neither NOT NULL, keys nor VARCHAR lengths, so a contract
states them and ``violations`` counts breaches in one pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Col:
    name: str
    type: str
    nullable: bool = True
    max_len: int | None = None


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[Col, ...]
    key: tuple[str, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def whole(self, *names: str) -> Contract:
        """The contract with the columns ``names`` kept as VARIANT (JSN-4)."""
        return replace(self, columns=tuple(replace(c, type="variant") if c.name in names else c for c in self.columns))


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns in order, cast to the declared types.
    A column missing from ``df`` becomes a typed NULL column (PRJ-4)."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(c.name) if c.name in present else F.lit(None)).cast(c.type).alias(c.name)
            for c in contract.columns
        ]
    )


def checks(contract: Contract) -> list[tuple[str, str, Column]]:
    """(rule, column, condition of a breach) of every check on single rows."""
    out: list[tuple[str, str, Column]] = []
    for c in contract.columns:
        if not c.nullable or c.name in contract.key:
            out.append(("not_null", c.name, F.col(c.name).isNull()))
        if c.max_len is not None:
            out.append(("max_length", c.name, F.length(F.col(c.name)) > c.max_len))
    return out


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows ``(table_name, rule, column_name, violations)``, one per check.

    One scan: rows are grouped on the contract key (partial aggregation
    map-side, so a hot key costs one row per partition in the shuffle), each
    group carries its row count and per-check counts, and a global sum over
    the groups gives every figure. Without a key it is one global aggregate.
    """
    found = checks(contract)
    if not found and not contract.key:
        raise ValueError(f"contract {contract.table} declares no checks")
    counts = [F.count_if(cond).alias(f"_c{i}") for i, (_, _, cond) in enumerate(found)]
    if contract.key:
        groups = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("_n"), *counts)
        totals = groups.agg(
            *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(found))],
            F.sum(F.col("_n") - 1).alias("_dup"),
        )
        found.append(("unique", ",".join(contract.key), None))
    else:
        totals = df.agg(*counts)
    items = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(col).alias("column_name"),
            F.coalesce(F.col("_dup" if cond is None else f"_c{i}"), F.lit(0)).cast("bigint").alias("violations"),
        )
        for i, (rule, col, cond) in enumerate(found)
    ]
    return totals.select(F.inline(F.array(*items))).select(
        F.lit(contract.table).alias("table_name"), "rule", "column_name", "violations"
    )
