"""Keys and references of the activity fact, checked against all that is stored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall import schemas
from rollcall.operators import audit, dims
from rollcall.operators.loads import Store
from rollcall.operators.rules import rule_rows
from rollcall.plans.quality import FACT_TABLE, PIPELINE
from rollcall.storage import land

#: What identifies a fact in its source.
FACT_KEY = ("source_system", "source_record_id", "activity_type_key")
UNIQUE_RULE = "UNIQUE_" + "_".join(name.upper() for name in FACT_KEY)
#: Columns of the fact that point at a dimension, and its key there; null points at nothing.
REFERENCES = {"date_key": "dim_date", "employee_key": "dim_employee", "project_key": "dim_project", "training_key": "dim_training"}
_TARGET = schemas.TARGET


@dataclass(frozen=True)
class Checked:
    """Facts that may be stored, and the quality rows and error rows of the check."""

    accepted: DataFrame
    results: DataFrame
    errors: DataFrame


def _digest() -> Column:
    return F.sha2(F.concat_ws("\u0001", *(F.coalesce(F.col(name).cast("string"), F.lit("\u0002")) for name in FACT_KEY)), 256)


def digests(facts: DataFrame, digits: int) -> DataFrame:
    """The ``fact_digest`` rows of stored facts."""
    return facts.select(_digest().alias("fact_digest")).withColumn("bucket", F.substring("fact_digest", 1, digits))


def repeated(facts: DataFrame, history: DataFrame) -> DataFrame:
    """fact_digest, etl_run_id, copies of every key that stands before, or more often than once, with the copies that are too many.

    ``history`` has the digests of stored facts. Copies are counted before they are shuffled, so a key that very
    many rows share is one row; the rows of the run with the lowest number come first.
    """
    per_run = facts.groupBy(_digest().alias("fact_digest"), "etl_run_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.coalesce("etl_run_id", F.lit(0).cast("bigint"))).over(Window.partitionBy("fact_digest"))
    stored = history.select("fact_digest").distinct().withColumn("stored", F.lit(True))
    found = per_run.withColumn("first_run", first).join(stored, "fact_digest", "left")
    own = F.when(F.col("stored").isNull() & F.col("first_run").eqNullSafe(F.coalesce("etl_run_id", F.lit(0).cast("bigint"))), 1).otherwise(0)
    return found.withColumn("copies", F.col("n") - own).where("copies > 0").select("fact_digest", "etl_run_id", "copies", "stored")


def orphans(facts: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """The values of ``column`` that the parent does not have. Facts are reduced to distinct values first, so a hot key is one row."""
    return facts.where(F.col(column).isNotNull()).select(column).distinct().join(parent.select(column).distinct(), column, "left_anti")


def _parents(store: Store, batch: int) -> dict[str, DataFrame]:
    """Keys of the dimensions as the open batch sees them. Without any employee there is the unknown one."""
    spark = store.spark
    known = {table: store.version(table, _TARGET[table], batch) for table in ("dim_employee", "dim_project", "dim_training")}
    known["dim_employee"] = known["dim_employee"].select("employee_key").union(dims.unknown_employee(spark).select("employee_key"))
    return {**known, "dim_date": dims.calendar(spark)}


def checked_facts(store: Store, facts: DataFrame, batch: int, part: str) -> Checked:
    """Facts of one part of an open batch next to all stored facts and the dimensions.

    Of the stored digests only the buckets are read that the incoming ones fall into.
    """
    buckets = [row[0] for row in digests(facts, store.digits).select("bucket").distinct().collect()]  # bounded by their number
    schema = _TARGET["fact_digest"]
    committed = store.rows("fact_digest", schema).where(F.col("bucket").isin(buckets))
    other_parts = store.rows("fact_digest", schema, batch, not_part=part).where(F.col("bucket").isin(buckets))
    twice = land(repeated(facts, committed.unionByName(other_parts)), "repeated")

    parents = _parents(store, batch)
    of = lambda column, table: orphans(facts, column, parents[table]).select(F.lit(column).alias("column"), F.col(column).cast("bigint").alias("value"))
    lost = land(reduce(DataFrame.union, [of(column, table) for column, table in REFERENCES.items()]), "orphans")
    rejected = [row[0] for row in lost.select("column").distinct().orderBy("column").collect()]  # names of columns
    keyed = facts
    for column in rejected:
        marked = lost.where(F.col("column") == column).select(F.col("value").alias(column), F.lit(True).alias(f"_lost_{column}"))
        keyed = keyed.join(marked, column, "left")
    failing = [F.when(F.col(f"_lost_{column}"), F.lit(f"REFERENCE_{column.upper()}")) for column in rejected]
    keyed = keyed.withColumn("_rule", F.coalesce(*failing) if failing else F.lit(None).cast("string"))
    keyed = keyed.drop(*(f"_lost_{column}" for column in rejected))

    accepted = keyed.where("_rule IS NULL").drop("_rule")
    has_copies = not twice.isEmpty()
    if has_copies:
        stored = twice.where("stored").select("fact_digest").distinct()
        inside = twice.where("stored IS NULL").select("fact_digest").distinct()
        # A digest is never null; said here, both branches below use one exchange.
        digested = accepted.withColumn("fact_digest", _digest()).where("fact_digest IS NOT NULL")
        alone = digested.join(twice.select("fact_digest").distinct(), "fact_digest", "left_anti")
        # One row of each key that the batch itself repeats: the first by run, then by its own columns.
        row = F.struct(F.coalesce("etl_run_id", F.lit(0).cast("bigint")).alias("_first"), *accepted.columns)
        kept = digested.join(inside, "fact_digest", "left_semi").join(stored, "fact_digest", "left_anti").groupBy("fact_digest").agg(F.min(row).alias("_row"))
        accepted = alone.select(*accepted.columns).unionByName(kept.select(*(F.col(f"_row.{c}").alias(c) for c in accepted.columns)))
    return Checked(accepted, _results(twice, keyed), _errors(facts, twice if has_copies else None, keyed))


def _results(twice: DataFrame, keyed: DataFrame) -> DataFrame:
    """A quality row per run and rule, out of one count over the facts."""
    names = {column: f"REFERENCE_{column.upper()}" for column in REFERENCES}
    counted = keyed.groupBy(F.col("etl_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("checked_rows"), *(F.count_if(F.col("_rule") == rule).alias(column) for column, rule in names.items())
    )
    copies = twice.groupBy(F.col("etl_run_id").alias("of_run")).agg(F.sum("copies").alias("copies"))
    found = counted.join(copies, counted["run_id"].eqNullSafe(copies["of_run"]), "left")
    rule = lambda name, column, failed, details: F.struct(
        F.lit(name).alias("rule_name"), F.lit(column.upper()).alias("column_name"), F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed_rows"), F.lit(details).alias("details")
    )
    rules = [rule(UNIQUE_RULE, ",".join(FACT_KEY), F.col("copies"), "Facts whose source record is stored before, or more than once.")]
    rules += [rule(name, column, F.col(column), "Facts that point at a member that does not exist.") for column, name in names.items()]
    return rule_rows(found.select("run_id", "checked_rows", F.inline(F.array(*rules))), FACT_TABLE)


def _errors(facts: DataFrame, twice: DataFrame | None, keyed: DataFrame) -> DataFrame:
    """An error row per fact without its member, and per key and run that repeats, with the number of copies."""
    lost = audit.error_rows(
        keyed.where("_rule IS NOT NULL").withColumnRenamed("etl_run_id", "run_id"), pipeline=PIPELINE, source="source_system", code=F.col("_rule"),
        message=F.concat(F.lit("The fact breaks "), "_rule"), raw_record="source_record_id",
    )
    if twice is None:
        return lost
    names = facts.select(_digest().alias("fact_digest"), "source_system", "source_record_id").join(
        twice.select("fact_digest").distinct(), "fact_digest", "left_semi"
    ).distinct()
    copies = twice.join(names, "fact_digest").withColumnRenamed("etl_run_id", "run_id")
    return lost.unionByName(audit.error_rows(
        copies, pipeline=PIPELINE, source="source_system", code=F.lit(UNIQUE_RULE),
        message=F.concat(F.lit("The source record is stored before or repeated, copies rejected: "), F.col("copies").cast("string")), raw_record="source_record_id",
    ))
