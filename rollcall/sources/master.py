"""Employee master out of name and email lists (R9, U-CAT, P5, G6, O2, P6, K8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.text import normalise_email, normalise_name
from rollcall.operators.stage import default_attributes


def people_list(df: DataFrame, name: str, email: str, row_number: str, file_order: int) -> DataFrame:
    """One source of people; ``file_order`` is its place among the sources. A source of several files orders them by ``file_name``."""
    return df.select(
        F.lit(file_order).alias("file_order"), F.lit("").alias("file_name"), F.col(row_number).cast("bigint").alias("row_number"),
        normalise_name(name).alias("employee_name"), normalise_email(email).alias("employee_id"),
    )


def employee_master(sources: list[DataFrame]) -> DataFrame:
    """Distinct employees by email, the first one in file order, sorted by name.

    The first row per email is found by an aggregation, which combines on the map side, so an email
    that fills a third of the rows costs no more than any other. Rows without an email are left out.
    """
    people = reduce(DataFrame.unionByName, sources).where(F.col("employee_id") != "")
    first = people.groupBy("employee_id").agg(
        F.min_by("employee_name", F.struct("file_order", "file_name", "row_number")).alias("employee_name")
    )
    named = first.select("employee_name", "employee_id")
    return default_attributes(named).orderBy("employee_name", "employee_id")


def rejected_people(sources: list[DataFrame]) -> DataFrame:
    """Rows without an email, for the reject log."""
    return reduce(DataFrame.unionByName, sources).where(F.col("employee_id") == "").select(
        "file_order", "row_number", "employee_name", F.lit("NO_EMAIL").alias("error_code")
    )
