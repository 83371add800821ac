"""Reject log and quality results over staged meetings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rollcall.operators import audit
from rollcall.operators.rules import Check, failing_rows, minimum, not_null, quality_rows, rule_rows

PIPELINE = "TRAINING_ATTENDANCE"


def staging_rejects(staged: DataFrame, raw: DataFrame, raw_id: str, code: str) -> DataFrame:
    """INVALID rows with the file, row number and raw record they came from."""
    lineage = raw.select(raw_id, "source_file_name", "source_row_number", "raw_record")
    return (
        staged.where(F.col("validation_status") == "INVALID")
        .select(raw_id, "run_id", "validation_message")
        .join(lineage, raw_id)
        .select(
            "run_id", F.lit(PIPELINE).alias("pipeline_name"),
            F.col("source_file_name").alias("source_name"), "source_row_number",
            F.lit(code).alias("error_code"), F.col("validation_message").alias("error_message"), "raw_record",
        )
    )


def participant_rejects(staged: DataFrame, raw: DataFrame) -> DataFrame:
    return staging_rejects(staged, raw, "participant_raw_id", "INVALID_PARTICIPANT")


def activity_rejects(staged: DataFrame, raw: DataFrame) -> DataFrame:
    return staging_rejects(staged, raw, "activity_raw_id", "INVALID_ACTIVITY")


def session_rejects(staged: DataFrame, raw: DataFrame) -> DataFrame:
    """INVALID sessions, which have no row number: the whole file is the record."""
    whole = raw.withColumn("source_row_number", F.lit(None).cast("bigint")).withColumn(
        "raw_record", F.col("source_file_name")
    )
    return staging_rejects(staged, whole, "session_raw_id", "INVALID_SESSION")


def _status_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(F.col("validation_status") == "INVALID").alias("failed_rows"),
    )


def reported_counts(sessions: DataFrame, participants: DataFrame) -> DataFrame:
    """Sessions whose reported count differs from their parsed participants, per run (A10).

    A session without a reported count is checked but never counted as different.
    """
    parsed = participants.groupBy("session_raw_id").agg(F.count(F.lit(1)).alias("parsed"))
    differs = F.col("reported_participant_count") != F.coalesce("parsed", F.lit(0))
    return (
        sessions.select("run_id", "session_raw_id", "reported_participant_count")
        .join(parsed, "session_raw_id", "left")
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("checked_rows"), F.count_if(differs).alias("failed_rows"))
    )


def unparsed_durations(raw: DataFrame) -> DataFrame:
    """Duration text that is not blank and holds no hours, minutes or seconds."""
    text = F.lower(F.trim("in_meeting_duration_raw"))
    return raw.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if((text != "") & ~text.rlike(r"[0-9]+\s*[hms]")).alias("failed_rows"),
    )


def quality_results(
    sessions: DataFrame, participants: DataFrame, activities: DataFrame, participant_raw: DataFrame
) -> DataFrame:
    """All quality rows of the staged runs."""
    results = [
        quality_rows(
            _status_counts(participants), "TRAINING_PARTICIPANT_VALIDATION", "STAGING.STG_TRAINING_PARTICIPANT",
            None, on_failure="FAILED", details="Checks participant identity and duration.",
        ),
        quality_rows(
            _status_counts(activities), "TRAINING_ACTIVITY_VALIDATION", "STAGING.STG_TRAINING_ACTIVITY",
            None, on_failure="FAILED", details="Checks activity participant and duration.",
        ),
        quality_rows(
            reported_counts(sessions, participants), "REPORTED_VS_PARSED_PARTICIPANTS",
            "STAGING.STG_TRAINING_SESSION", "REPORTED_PARTICIPANT_COUNT", on_failure="WARNING",
            details="Compares the summary participant count with parsed participant rows.",
        ),
        quality_rows(
            _status_counts(sessions), "TRAINING_SESSION_VALIDATION", "STAGING.STG_TRAINING_SESSION",
            None, on_failure="FAILED", details="Checks meeting title, start and end.",
        ),
        quality_rows(
            unparsed_durations(participant_raw), "TRAINING_DURATION_UNPARSED", "STAGING.STG_TRAINING_PARTICIPANT",
            "DURATION_SECONDS", on_failure="WARNING", details="Duration text without hours, minutes or seconds.",
        ),
    ]
    return reduce(DataFrame.unionByName, results)


def reject_log(*rejects: DataFrame) -> DataFrame:
    """Every rejected record of every stage in one table."""
    return reduce(DataFrame.unionByName, rejects)


FACT_TABLE = "TARGET.FACT_EMPLOYEE_ACTIVITY"


def fact_checks() -> list[Check]:
    """Constraints of the activity fact. Hours are missing where a source has none, or negative ones."""
    needed = ("employee_key", "date_key", "activity_type_key", "source_system", "source_record_id", "hours")
    return [*(not_null(column) for column in needed), minimum("hours", 0)]


def fact_constraints(facts: DataFrame) -> DataFrame:
    """Quality rows of all fact constraints per run, in one pass over the facts (V6, V8, A5)."""
    checks = fact_checks()
    counted = facts.groupBy(F.col("etl_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("checked_rows"), *[F.count_if(check.failed).alias(f"f{i}") for i, check in enumerate(checks)]
    )
    each = [
        F.struct(
            F.lit(check.name).alias("rule_name"), F.lit(check.column.upper()).alias("column_name"), F.col(f"f{i}").alias("failed_rows"),
            F.lit("Rows that break a constraint of the fact.").alias("details"),
        )
        for i, check in enumerate(checks)
    ]
    return rule_rows(counted.select("run_id", "checked_rows", F.inline(F.array(*each))), FACT_TABLE)


def fact_rejects(facts: DataFrame) -> DataFrame:
    """Error rows of facts that break a constraint (D7); the facts themselves stay."""
    broken = failing_rows(facts.withColumnRenamed("etl_run_id", "run_id"), fact_checks())
    return audit.error_rows(
        broken, pipeline=PIPELINE, source="source_system", code=F.col("rule_name"),
        message=F.concat(F.lit("The fact breaks "), "rule_name"), raw_record="source_record_id",
    )
