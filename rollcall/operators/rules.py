"""Row validation, constraint checks and the quality rows they give."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``failed`` is true for a row that breaks the rule."""

    message: str
    failed: Column


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``validation_message`` (the first broken rule) and ``validation_status``."""
    message = F.coalesce(*[F.when(rule.failed, F.lit(rule.message)) for rule in rules])
    return df.withColumn("validation_message", message).withColumn(
        "validation_status", F.when(F.col("validation_message").isNull(), "VALID").otherwise("INVALID")
    )


def valid_only(df: DataFrame) -> DataFrame:
    """V4."""
    return df.where(F.col("validation_status") == "VALID")


def quality_rows(
    counts: DataFrame, rule: str, table: str, column: str | None, *, on_failure: str, details: str
) -> DataFrame:
    """Quality results out of rows with ``run_id``, ``checked_rows`` and ``failed_rows`` (A5)."""
    status = F.when(F.col("failed_rows") == 0, "PASSED").otherwise(on_failure.upper())
    return counts.select(
        "run_id",
        F.lit(rule).alias("rule_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        status.alias("result_status"),
        F.col("checked_rows").cast("bigint").alias("checked_rows"),
        F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.lit(details).alias("details"),
    )


def rule_rows(counts: DataFrame, table: str) -> DataFrame:
    """Quality results out of rows that name their rule: run_id, checked_rows, rule_name, column_name, failed_rows, details."""
    status = F.when(F.col("failed_rows") == 0, "PASSED").otherwise("FAILED")
    return counts.select(
        "run_id", "rule_name", F.lit(table).alias("table_name"), "column_name", status.alias("result_status"),
        F.col("checked_rows").cast("bigint").alias("checked_rows"), F.col("failed_rows").cast("bigint").alias("failed_rows"), "details",
    )


@dataclass(frozen=True)
class Check:
    """A row condition of a table: domain, not null, length (V6, V8)."""

    name: str
    column: str
    failed: Column


def not_null(column: str) -> Check:
    return Check(f"NOT_NULL_{column.upper()}", column, F.col(column).isNull())


def max_length(column: str, limit: int) -> Check:
    return Check(f"LENGTH_{column.upper()}", column, F.coalesce(F.length(column) > limit, F.lit(False)))


def domain(column: str, *values: str) -> Check:
    return Check(f"DOMAIN_{column.upper()}", column, F.col(column).isNotNull() & ~F.col(column).isin(*values))


def minimum(column: str, least: int) -> Check:
    return Check(f"MINIMUM_{column.upper()}", column, F.coalesce(F.col(column) < least, F.lit(False)))


def check_rows(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row checks of a table in one pass: a row per check with checked and failed counts."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        *[F.count_if(check.failed).alias(f"f{i}") for i, check in enumerate(checks)],
    )
    results = F.array(*[
        F.struct(
            F.lit(check.name).alias("rule_name"), F.lit(table).alias("table_name"),
            F.lit(check.column).alias("column_name"), "checked_rows", F.col(f"f{i}").alias("failed_rows"),
        )
        for i, check in enumerate(checks)
    ])
    return counted.select(F.inline(results))


def failing_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that break a check, once per broken check, for the reject log."""
    broken = F.filter(
        F.array(*[F.when(check.failed, F.lit(check.name)) for check in checks]), lambda name: name.isNotNull()
    )
    any_broken = reduce(lambda a, b: a | b, [check.failed for check in checks])
    return df.where(any_broken).withColumn("rule_name", F.explode(broken))


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys do not collide (V7)."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first(complete).alias("complete"))
    return per_key.agg(
        F.lit("UNIQUE_" + "_".join(k.upper() for k in keys)).alias("rule_name"),
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(F.col("complete"), F.col("n") - 1)), F.lit(0)).alias("failed_rows"),
    )


def check_reference(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is missing in the parent (V8).

    Child rows are counted per key before the join, so a hot key is one row in it.
    """
    per_key = child.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("key"), F.lit(True).alias("known")).distinct()
    orphan = F.col("key").isNotNull() & F.col("known").isNull()
    return per_key.join(known, "key", "left").agg(
        F.lit(f"REFERENCE_{column.upper()}").alias("rule_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("failed_rows"),
    )
