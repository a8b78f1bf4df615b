"""Data-quality rules, the report over them and the gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vidlake.schemas import CANONICAL, DATE_PARTS, METRICS, REQUIRED, SNAPSHOT_KEY

ROWS = "rows"
EMPTY = "empty_table"
DUPLICATES = "duplicate_snapshot"
BLANK_TITLE = "blank_title"
# Counted for information; neither fails the gate.
INFORMATIVE = (ROWS, BLANK_TITLE)


class QualityError(ValueError):
    """The gate is shut. ``failures`` names every rule that failed."""

    def __init__(self, failures: Sequence[str]):
        self.failures = list(failures)
        super().__init__("; ".join(self.failures))


def missing_columns(
    df: DataFrame, expected: Sequence[str] = (*CANONICAL, *DATE_PARTS)
) -> list[str]:
    """Expected columns the table lacks; names compare as Spark resolves them."""
    present = {name.lower() for name in df.columns}
    return [name for name in expected if name not in present]


def row_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Per rule, when a row breaks it; rules on absent columns are left out."""
    present = set(columns)
    rules = {f"null_{c}": F.col(c).isNull() for c in REQUIRED if c in present}
    rules |= {f"negative_{c}": F.col(c) < 0 for c in METRICS if c in present}
    rules |= {
        f"{c}_over_views": F.col(c) > F.col("views")
        for c in ("likes", "comments")
        if {c, "views"} <= present
    }
    parts = [F.col(c).isNull() for c in DATE_PARTS if c in present]
    if parts:
        rules["null_partition"] = reduce(lambda left, right: left | right, parts)
    if "title" in present:
        rules[BLANK_TITLE] = F.col("title") == ""
    return rules


def rule_counts(columns: Sequence[str]) -> list[Column]:
    """Row count and one violation count per row rule, for agg() or observe()."""
    counts = [F.count(F.lit(1)).alias(ROWS)]
    return counts + [F.count_if(broken).alias(rule) for rule, broken in row_rules(columns).items()]


def null_counts(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """NULLs per column, all in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    return df.agg(*counts).unpivot([], list(columns), "column_name", "nulls")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def quality_report(df: DataFrame, expected: Sequence[str] = (*CANONICAL, *DATE_PARTS)) -> DataFrame:
    """(rule, violations) for every rule, from one read of the table.

    Counts are made per snapshot key and then added up, so the duplicate check
    rides along; rows combine before the shuffle, and no shuffle is added when
    the table has just been de-duplicated on the same key.
    """
    keys = [name for name in SNAPSHOT_KEY if name in df.columns]
    rules = [ROWS, *row_rules(df.columns)]
    per_key = df.groupBy(*keys).agg(*rule_counts(df.columns))
    sums = [F.coalesce(F.sum(rule), F.lit(0)).cast("bigint").alias(rule) for rule in rules]
    surplus = F.coalesce(F.sum(F.col(ROWS) - 1), F.lit(0)).cast("bigint").alias(DUPLICATES)
    absent = F.lit(len(missing_columns(df, expected))).cast("bigint").alias("missing_columns")
    totals = per_key.agg(*sums, surplus).withColumn("missing_columns", absent)
    totals = totals.withColumn(EMPTY, (F.col(ROWS) == 0).cast("bigint"))
    return totals.unpivot([], totals.columns, "rule", "violations")


def failed_rules(report: DataFrame) -> DataFrame:
    """The rules of a report that shut the gate."""
    return report.filter((F.col("violations") > 0) & ~F.col("rule").isin(*INFORMATIVE))


def failures_in(counts: Mapping[str, int]) -> list[str]:
    """The same over plain counts, such as an Observation brings back."""
    return [
        f"{rule}: {count}"
        for rule, count in counts.items()
        if count > 0 and rule not in INFORMATIVE
    ]


def enforce(df: DataFrame) -> None:
    """Collect every failure of the table, then raise once if there is any."""
    absent = missing_columns(df)
    if absent:
        raise QualityError([f"missing column {name}" for name in absent])
    counts = {row.rule: row.violations for row in failed_rules(quality_report(df)).collect()}
    if counts:
        raise QualityError(failures_in(counts))
