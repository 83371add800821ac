"""Table schemas of the four layers: sources, staging, target and control."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "decimal(18,2)": T.DecimalType(18, 2), "decimal(28,2)": T.DecimalType(28, 2),
}


def _schema(text: str) -> T.StructType:
    """``name type, name type`` as a schema; unlike fromDDL this needs no session."""
    return T.StructType([T.StructField(*_named(column)) for column in text.split(", ")])


def _named(column: str) -> tuple[str, T.DataType]:
    name, kind = column.split()
    return name, _TYPES[kind]


_LINEAGE = "dataset_name string, source_file_name string"
_CHECKED = "validation_status string, validation_message string"
_EMPLOYEE = (
    "employee_id string, employee_name string, grade string, discipline string, "
    "line_manager string, delivery_unit string"
)

SOURCES = {
    "employee_master_raw": _schema(
        f"raw_employee_key bigint, {_EMPLOYEE}, {_LINEAGE}, process_timestamp timestamp"
    ),
    "training_session_raw": _schema(
        f"session_raw_id bigint, session_source_key string, run_id bigint, {_LINEAGE}, "
        "source_file_hash string, meeting_title_raw string, attended_participants_raw string, "
        "start_time_raw string, end_time_raw string, meeting_duration_raw string, "
        "average_attendance_time_raw string, process_timestamp timestamp"
    ),
    "training_participant_raw": _schema(
        f"participant_raw_id bigint, session_raw_id bigint, run_id bigint, {_LINEAGE}, "
        "source_row_number bigint, participant_name_raw string, first_join_raw string, "
        "last_leave_raw string, in_meeting_duration_raw string, email_raw string, "
        "participant_id_raw string, role_raw string, raw_record string, process_timestamp timestamp"
    ),
    "training_activity_raw": _schema(
        f"activity_raw_id bigint, session_raw_id bigint, run_id bigint, {_LINEAGE}, "
        "source_row_number bigint, participant_name_raw string, join_time_raw string, "
        "leave_time_raw string, duration_raw string, email_raw string, "
        "participant_id_raw string, role_raw string, raw_record string, process_timestamp timestamp"
    ),
}

SOURCES |= {
    # Files of timesheets and exam schedules that are loaded.
    "activity_file": _schema("path string, file_name string, length bigint, source_file_hash string, run_id bigint"),
    # Every file that a load has looked at: where it lies, how it looked from outside, and what it held.
    "known_file": _schema("path string, length bigint, modified timestamp, source_file_hash string"),
    # Loaded meetings, once by the hash of their file and once by their own key.
    "known_hash": _schema("source_file_hash string, session_source_key string"),
    "known_session": _schema("source_file_hash string, session_source_key string"),
}

STAGING = {
    "stg_employee": _schema(f"{_EMPLOYEE}, {_CHECKED}, {_LINEAGE}, process_timestamp timestamp"),
    "stg_training_session": _schema(
        "session_raw_id bigint, run_id bigint, session_source_key string, meeting_title string, "
        "reported_participant_count bigint, start_timestamp timestamp_ntz, "
        "end_timestamp timestamp_ntz, meeting_duration_seconds bigint, "
        f"average_attendance_seconds bigint, {_CHECKED}"
    ),
    "stg_training_participant": _schema(
        "participant_raw_id bigint, session_raw_id bigint, run_id bigint, participant_name string, "
        "email string, participant_id string, participant_role string, "
        "first_join_timestamp timestamp_ntz, last_leave_timestamp timestamp_ntz, "
        f"duration_seconds bigint, {_CHECKED}"
    ),
    "stg_training_activity": _schema(
        "activity_raw_id bigint, session_raw_id bigint, run_id bigint, participant_name string, "
        "email string, participant_id string, participant_role string, "
        "join_timestamp timestamp_ntz, leave_timestamp timestamp_ntz, "
        f"duration_seconds bigint, {_CHECKED}"
    ),
}

TARGET = {
    "dim_date": _schema(
        "date_key int, full_date date, day_number int, day_name string, week_number int, "
        "month_number int, month_name string, quarter_number int, year_number int, "
        "is_weekend string"
    ),
    "dim_activity_type": _schema(
        "activity_type_key int, activity_code string, activity_name string, description string"
    ),
    "dim_employee": _schema(
        f"employee_key bigint, {_EMPLOYEE}, dataset_name string, process_timestamp timestamp"
    ),
    "dim_project": _schema("project_key bigint, project_name string"),
    "dim_training": _schema(
        "training_key bigint, training_source_key string, training_name string, "
        "session_start_timestamp timestamp_ntz, session_end_timestamp timestamp_ntz, "
        "reported_participant_count bigint, source_system string, source_record_id string, "
        "load_timestamp timestamp"
    ),
    "fact_employee_activity": _schema(
        "activity_key bigint, employee_key bigint, date_key int, activity_type_key int, "
        "project_key bigint, training_key bigint, source_system string, source_record_id string, "
        "hours decimal(18,2), load_timestamp timestamp, etl_run_id bigint"
    ),
    # What identifies a fact in its source, as a digest; the first two digits are its bucket.
    "fact_digest": _schema("fact_digest string, bucket string"),
    # Sums of the facts of a batch, which add up.
    "fact_month": _schema(
        "employee_key bigint, year_number int, month_number int, month_name string, activity_code string, hours decimal(28,2), activity_count bigint"
    ),
}

CONTROL = {
    "etl_run": _schema(
        "run_id bigint, pipeline_name string, source_name string, start_time timestamp, "
        "end_time timestamp, status string, rows_read bigint, rows_loaded bigint, "
        "rows_rejected bigint, error_message string"
    ),
    "etl_run_event": _schema(
        "run_id bigint, pipeline_name string, source_name string, event string, "
        "event_time timestamp, rows_read bigint, rows_loaded bigint, rows_rejected bigint, "
        "error_message string"
    ),
    "etl_error_log": _schema(
        "run_id bigint, pipeline_name string, source_name string, source_row_number bigint, "
        "error_code string, error_message string, raw_record string, created_at timestamp"
    ),
    "data_quality_result": _schema(
        "run_id bigint, rule_name string, table_name string, column_name string, "
        "result_status string, checked_rows bigint, failed_rows bigint, details string, "
        "checked_at timestamp"
    ),
}
