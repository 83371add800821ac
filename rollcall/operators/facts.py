"""Rows of the activity fact out of meetings, timesheets and exams.

An employee is found by email, or by name where a source has no email and the name is unique.
Anyone not found gets the unknown member. Rows without an email can match nobody; they are given
a key of their own for the join, so that they spread over all tasks instead of meeting in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.text import blank_to_null, col
from rollcall.operators.dims import ACTIVITY_TYPES, UNKNOWN_KEY

MEETING_SYSTEM = "MEETING_ATTENDANCE"
TIMESHEET_SYSTEM = "TIMESHEET"
EXAM_SYSTEM = "EXAM_SCHEDULE"
_TYPE_KEY = {code: key for key, code, _, _ in ACTIVITY_TYPES}


def date_key(day) -> Column:
    return F.date_format(col(day), "yyyyMMdd").cast("int")


def _spread(key: Column, unique_record: str) -> Column:
    """``key``, or where it is null a text of the row's own that matches nothing."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.col(unique_record).cast("string")))


def _with_employee(rows: DataFrame, key: Column, known: DataFrame, unique_record: str) -> DataFrame:
    """Rows with the ``employee_key`` that ``known`` (_key, employee_key) has for the key."""
    found = rows.withColumn("_key", _spread(key, unique_record)).join(known, "_key", "left")
    return found.withColumn("employee_key", F.coalesce("employee_key", F.lit(UNKNOWN_KEY).cast("bigint"))).drop("_key")


def _by_email(rows: DataFrame, email: str, dim_employee: DataFrame, unique_record: str) -> DataFrame:
    known = dim_employee.where(F.col("employee_key") != UNKNOWN_KEY).select(
        F.lower(F.trim("employee_id")).alias("_key"), "employee_key"
    )
    return _with_employee(rows, F.lower(blank_to_null(email)), known, unique_record)


def _by_unique_name(rows: DataFrame, name: str, dim_employee: DataFrame, unique_record: str) -> DataFrame:
    known = (
        dim_employee.where(F.col("employee_key") != UNKNOWN_KEY)
        .groupBy(F.lower(F.trim("employee_name")).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("employee_key").alias("employee_key"))
        .where("_n = 1")
        .drop("_n")
    )
    return _with_employee(rows, F.lower(blank_to_null(name)), known, unique_record)


def _fact(rows: DataFrame, code: str, system: str, *, day, hours: Column, record: Column, project=None, training=None) -> DataFrame:
    """The fact columns; ``hours`` that are missing or negative stay visible as null."""
    def key(value) -> Column:
        return (F.lit(None) if value is None else col(value)).cast("bigint")

    return rows.select(
        "employee_key",
        date_key(day).alias("date_key"),
        F.lit(_TYPE_KEY[code]).alias("activity_type_key"),
        key(project).alias("project_key"),
        key(training).alias("training_key"),
        F.lit(system).alias("source_system"),
        record.cast("string").alias("source_record_id"),
        F.round(F.when(hours >= 0, hours).cast("decimal(24,6)"), 2).cast("decimal(18,2)").alias("hours"),
        F.col("run_id").cast("bigint").alias("etl_run_id"),
    )


def training_facts(
    participants: DataFrame, participant_raw: DataFrame, sessions: DataFrame, dim_training: DataFrame,
    dim_employee: DataFrame,
) -> DataFrame:
    """A TRAINING fact per VALID participant of a VALID session."""
    valid = F.col("validation_status") == "VALID"
    session = (
        sessions.where(valid)
        .select("session_raw_id", F.col("session_source_key").alias("training_source_key"), "start_timestamp")
        .join(dim_training.select("training_source_key", "training_key"), "training_source_key", "left")
    )
    rows = (
        participants.where(valid)
        .join(participant_raw.select("participant_raw_id", "source_row_number"), "participant_raw_id")
        .join(session, "session_raw_id")
    )
    day = F.coalesce("first_join_timestamp", "start_timestamp").cast("date")
    return _fact(
        _by_email(rows, "email", dim_employee, "participant_raw_id"), "TRAINING", MEETING_SYSTEM,
        day=day, hours=F.col("duration_seconds").cast("decimal(20,0)") / 3600,
        record=F.concat_ws("|", "training_source_key", F.col("source_row_number").cast("string")),
        training="training_key",
    )


def work_facts(timesheet: DataFrame, dim_employee: DataFrame, dim_project: DataFrame) -> DataFrame:
    """A WORK fact per timesheet row (record_id, email, project_name, work_date, hours, run_id)."""
    rows = _by_email(timesheet, "email", dim_employee, "record_id")
    projects = dim_project.select("project_key", F.col("project_name").alias("_project"))
    named = rows.withColumn("_project", _spread(F.col("project_name"), "record_id"))
    return _fact(
        named.join(projects, "_project", "left"), "WORK", TIMESHEET_SYSTEM,
        day="work_date", hours=F.col("hours"), record=F.col("record_id"), project="project_key",
    )


def absence_facts(absences: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """D3: an ABSENCE fact per timesheet row."""
    return _fact(
        _by_email(absences, "email", dim_employee, "record_id"), "ABSENCE", TIMESHEET_SYSTEM,
        day="work_date", hours=F.col("hours"), record=F.col("record_id"),
    )


def exam_facts(exams: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """An EXAM fact per scheduled exam; the source knows names only."""
    return _fact(
        _by_unique_name(exams, "employee_name", dim_employee, "record_id"), "EXAM", EXAM_SYSTEM,
        day="exam_date", hours=F.col("hours"), record=F.col("record_id"),
    )
