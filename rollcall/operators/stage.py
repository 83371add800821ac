"""Raw text to typed and validated staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.clock import parse_duration, with_timestamps
from rollcall.functions.text import blank_to_null
from rollcall.operators.rules import Rule, validate

# Validation messages and the attributes a generated employee gets.
TITLE_MISSING = "Meeting title is missing."
START_INVALID = "Start timestamp is invalid."
END_INVALID = "End timestamp is invalid."
PARTICIPANT_MISSING = "Participant identifier is missing."
PARTICIPANT_DURATION = "Participant duration is invalid."
ACTIVITY_MISSING = "Activity participant is missing."
ACTIVITY_DURATION = "Activity duration is invalid."
EMPLOYEE_DEFAULTS = {
    "grade": "JUNIOR",
    "discipline": "DATA_ENGINEERING",
    "line_manager": "UNKNOWN",
    "delivery_unit": "DU_DATA",
}


def stage_employees(raw: DataFrame) -> DataFrame:
    """Standardised employees, all marked valid, lineage kept."""
    return raw.select(
        F.lower(blank_to_null("employee_id")).alias("employee_id"),
        blank_to_null("employee_name").alias("employee_name"),
        F.upper(blank_to_null("grade")).alias("grade"),
        F.upper(blank_to_null("discipline")).alias("discipline"),
        blank_to_null("line_manager").alias("line_manager"),
        F.upper(blank_to_null("delivery_unit")).alias("delivery_unit"),
        F.lit("VALID").alias("validation_status"),
        F.lit(None).cast("string").alias("validation_message"),
        "dataset_name", "source_file_name", "process_timestamp",
    )


def default_attributes(employees: DataFrame) -> DataFrame:
    """The attributes no source carries."""
    return employees.withColumns({name: F.lit(value) for name, value in EMPLOYEE_DEFAULTS.items()})


def stage_sessions(raw: DataFrame) -> DataFrame:
    """P2, V1."""
    reported = F.trim("attended_participants_raw")
    timed = with_timestamps(raw, {"start_timestamp": "start_time_raw", "end_timestamp": "end_time_raw"})
    typed = timed.select(
        "session_raw_id", "run_id", "session_source_key",
        blank_to_null("meeting_title_raw").alias("meeting_title"),
        F.when(reported.rlike(r"^[0-9]+\z"), reported.try_cast("bigint")).alias("reported_participant_count"),
        "start_timestamp", "end_timestamp",
        parse_duration("meeting_duration_raw").alias("meeting_duration_seconds"),
        parse_duration("average_attendance_time_raw").alias("average_attendance_seconds"),
    )
    return validate(typed, [
        Rule(TITLE_MISSING, F.col("meeting_title").isNull()),
        Rule(START_INVALID, F.col("start_timestamp").isNull()),
        Rule(END_INVALID, F.col("end_timestamp").isNull()),
    ])


def _person() -> list:
    return [
        blank_to_null("participant_name_raw").alias("participant_name"),
        F.lower(blank_to_null("email_raw")).alias("email"),
        blank_to_null("participant_id_raw").alias("participant_id"),
        F.upper(blank_to_null("role_raw")).alias("participant_role"),
    ]


def _person_rules(missing: str, duration: str) -> list[Rule]:
    nobody = F.coalesce("participant_name", "email", "participant_id").isNull()
    return [Rule(missing, nobody), Rule(duration, F.col("duration_seconds").isNull())]


def stage_participants(raw: DataFrame) -> DataFrame:
    """P3, V2."""
    timed = with_timestamps(raw, {"first_join_timestamp": "first_join_raw", "last_leave_timestamp": "last_leave_raw"})
    typed = timed.select(
        "participant_raw_id", "session_raw_id", "run_id", *_person(), "first_join_timestamp", "last_leave_timestamp",
        parse_duration("in_meeting_duration_raw").alias("duration_seconds"),
    )
    return validate(typed, _person_rules(PARTICIPANT_MISSING, PARTICIPANT_DURATION))


def stage_activities(raw: DataFrame) -> DataFrame:
    """P4, V3."""
    timed = with_timestamps(raw, {"join_timestamp": "join_time_raw", "leave_timestamp": "leave_time_raw"})
    typed = timed.select(
        "activity_raw_id", "session_raw_id", "run_id", *_person(), "join_timestamp", "leave_timestamp",
        parse_duration("duration_raw").alias("duration_seconds"),
    )
    return validate(typed, _person_rules(ACTIVITY_MISSING, ACTIVITY_DURATION))
