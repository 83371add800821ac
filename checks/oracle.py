"""The model views in SQL, and the SQL each query is checked against.

The SQL works on the typed columns from which the raw texts were rendered. It does not parse them.
"""

from __future__ import annotations

import re

VIEWS = {
    "employee_rows": """
        SELECT c_custkey + 1 AS employee_key, lower(c_name) || '@example.com' AS employee_id, c_name AS employee_name,
            c_mktsegment AS grade, CASE WHEN c_acctbal < 0 THEN 'SUPPORT' ELSE 'DELIVERY' END AS discipline,
            'Manager ' || n_regionkey AS line_manager, n_name AS delivery_unit, 'CUSTOMER' AS dataset_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_employee": """
        SELECT * FROM employee_rows UNION ALL
        SELECT 0, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'SYSTEM'""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, day(d) AS day_number,
            upper(strftime(d, '%A')) AS day_name, weekofyear(d) AS week_number, month(d) AS month_number,
            upper(strftime(d, '%B')) AS month_name, quarter(d) AS quarter_number, year(d) AS year_number,
            CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend
        FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)""",
    "dim_activity_type": """
        SELECT * FROM (VALUES (1, 'WORK', 'Worked Hours', 'Hours worked by an employee on a project.'),
            (2, 'ABSENCE', 'Absence', 'Employee absence hours such as leave or sickness.'),
            (3, 'TRAINING', 'Training Attendance', 'Employee attendance at a training session or meeting.'),
            (4, 'EXAM', 'Exam Activity', 'Employee exam-related activity or scheduled exam absence.'))
            AS t(activity_type_key, activity_code, activity_name, description)""",
    "dim_training": "SELECT p_partkey AS training_key, p_name AS training_name FROM part",
    "dim_project": "SELECT s_suppkey AS project_key, s_name AS project_name FROM supplier",
    "fact": """
        SELECT event_id AS activity_key,
            CASE WHEN event_type = 'signup' THEN 0 WHEN event_type = 'error' AND user_id % 10 = 0 THEN -1
                ELSE user_id + 1 END AS employee_key,
            CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
            CASE WHEN event_type IN ('purchase', 'click') THEN 1 WHEN event_type = 'error' THEN 2
                WHEN event_type = 'view' THEN 3 ELSE 4 END AS activity_type_key,
            CASE WHEN event_type = 'purchase' THEN user_id END AS project_key,
            CASE WHEN event_type = 'view' THEN user_id END AS training_key,
            'EVENTS' AS source_system, CAST(event_id AS VARCHAR) AS source_record_id,
            CAST(value AS DECIMAL(18,2)) AS hours
        FROM events""",
    "sessions": """
        SELECT c_custkey, c_name, coalesce(n, 0) AS n,
            TIMESTAMP '1995-01-01 00:00:00' + to_seconds(c_custkey * 7919) AS start_ts,
            TIMESTAMP '1995-01-01 00:00:00' + to_seconds(c_custkey * 7919 + 5552) AS end_ts
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "participants": """
        SELECT o_orderkey, o_custkey, lower(o_orderpriority) AS role,
            o_orderdate + to_seconds(o_orderkey % 86400) AS join_ts,
            CAST(coalesce(q, 0) * 60 AS BIGINT) + o_orderkey % 12 AS seconds,
            o_orderdate + to_seconds(o_orderkey % 86400 + CAST(coalesce(q, 0) * 60 AS BIGINT) + o_orderkey % 12) AS leave_ts
        FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "activities": """
        SELECT l_orderkey * 10 + l_linenumber AS activity_id, l_orderkey, o_custkey, join_ts, seconds,
            join_ts + to_seconds(seconds) AS leave_ts
        FROM (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) * 60 AS BIGINT) AS seconds, min(l_shipdate) AS join_ts
            FROM lineitem GROUP BY 1, 2) JOIN orders ON o_orderkey = l_orderkey""",
    "stg_session": """
        SELECT *, CASE WHEN validation_message IS NULL THEN 'VALID' ELSE 'INVALID' END AS validation_status FROM (
            SELECT *, CASE WHEN meeting_title IS NULL THEN 'Meeting title is missing.'
                WHEN start_ts IS NULL THEN 'Start timestamp is invalid.'
                WHEN end_ts IS NULL THEN 'End timestamp is invalid.' END AS validation_message FROM (
                SELECT c_custkey + 1 AS session_raw_id, c_custkey % 25 + 1 AS run_id, lower(c_name) AS session_source_key,
                    'Meeting' || c_custkey || '.csv' AS source_file_name,
                    CASE WHEN c_custkey % 17 <> 0 THEN c_name || ' review' END AS meeting_title,
                    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN n + 1 ELSE n END AS reported_participant_count,
                    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN date_trunc('minute', start_ts) ELSE start_ts END AS start_ts,
                    CASE WHEN c_custkey % 29 <> 0 THEN end_ts END AS end_ts,
                    5552 AS meeting_duration_seconds,
                    CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 90 * 60 END AS average_attendance_seconds
                FROM sessions))""",
    "stg_participant": """
        SELECT *, CASE WHEN validation_message IS NULL THEN 'VALID' ELSE 'INVALID' END AS validation_status FROM (
            SELECT *, CASE WHEN coalesce(participant_name, email, participant_id) IS NULL THEN 'Participant identifier is missing.'
                WHEN duration_seconds IS NULL THEN 'Participant duration is invalid.' END AS validation_message FROM (
                SELECT o_orderkey, o_orderkey + 1 AS participant_raw_id, o_custkey + 1 AS session_raw_id, o_custkey % 25 + 1 AS run_id,
                    'Meeting' || o_custkey || '.csv' AS source_file_name, o_orderkey + 11 AS source_row_number,
                    CASE WHEN o_orderkey % 13 <> 0 THEN 'Person ' || o_orderkey END AS participant_name,
                    CASE WHEN o_orderkey % 3 <> 0 THEN 'p' || o_orderkey || '@example.com' END AS email,
                    CASE WHEN o_orderkey % 6 <> 0 THEN 'ID' || o_orderkey END AS participant_id,
                    upper(role) AS participant_role, join_ts, leave_ts,
                    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 0 ELSE seconds END AS duration_seconds,
                    o_orderkey || '|' || o_custkey AS raw_record
                FROM participants))""",
    "stg_activity": """
        SELECT *, CASE WHEN validation_message IS NULL THEN 'VALID' ELSE 'INVALID' END AS validation_status FROM (
            SELECT *, CASE WHEN coalesce(participant_name, email, participant_id) IS NULL THEN 'Activity participant is missing.'
                WHEN duration_seconds IS NULL THEN 'Activity duration is invalid.' END AS validation_message FROM (
                SELECT activity_id AS activity_raw_id, o_custkey + 1 AS session_raw_id, o_custkey % 25 + 1 AS run_id,
                    'Meeting' || o_custkey || '.csv' AS source_file_name, activity_id AS source_row_number,
                    CASE WHEN l_orderkey % 13 <> 0 THEN 'Person ' || l_orderkey END AS participant_name,
                    CASE WHEN l_orderkey % 3 <> 0 THEN 'p' || l_orderkey || '@example.com' END AS email,
                    CASE WHEN l_orderkey % 6 <> 0 THEN 'ID' || l_orderkey END AS participant_id,
                    'ATTENDEE' AS participant_role, join_ts, leave_ts,
                    CASE WHEN activity_id % 31 <> 0 THEN seconds END AS duration_seconds, CAST(activity_id AS VARCHAR) AS raw_record
                FROM activities))""",
    "training_source": """
        SELECT *, CASE WHEN reported_participant_count > 10 THEN 'part' || session_raw_id ELSE session_source_key END AS training_source_key
        FROM stg_session WHERE validation_status = 'VALID'""",
    "file_sessions": """
        SELECT *, 'Meeting' || c_custkey || '.csv' AS file_name, 'Révue ' || c_name AS title,
            strftime(start_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS start_text, strftime(end_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS end_text,
            sha256(lower('Révue ' || c_name) || '|' || strftime(start_ts, '%-m/%-d/%y, %-I:%M:%S %p')) AS session_source_key
        FROM sessions""",
    "file_people": """
        SELECT *, 'Meeting' || o_custkey || '.csv' AS file_name,
            10 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS source_row_number,
            CASE WHEN o_orderkey % 78 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN 'Pér, "' || o_orderkey || '"' ELSE 'Person ' || o_orderkey END AS name,
            CASE WHEN o_orderkey % 78 = 0 OR o_orderkey % 3 = 0 THEN '' ELSE 'P' || o_orderkey || '@Example.com' END AS email,
            CASE WHEN o_orderkey % 78 = 0 THEN '' ELSE 'ID' || o_orderkey END AS ident,
            strftime(join_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS join_text, strftime(leave_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS leave_text,
            seconds // 3600 || 'h ' || seconds % 3600 // 60 || 'm ' || seconds % 60 || 's' AS duration_text
        FROM participants""",
    "sheet_rows": """
        SELECT *, NOT short AS fits, CASE WHEN short THEN 'WIDTH' WHEN event_id % 41 = 0 THEN 'BAD_DAY' WHEN event_id % 43 = 0 THEN 'BAD_HOURS' END AS code,
            CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS hours
        FROM (
            SELECT *, kind || ' ' || user_id % 6 || '.csv' AS path, 2 + row_number() OVER (PARTITION BY kind, user_id % 6 ORDER BY event_id) AS row_number, event_id % 47 = 0 AS short,
                CASE WHEN kind = 'Exam_Absences' THEN 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') WHEN kind = 'Timesheet_Absences' THEN 'Absent ' || user_id ELSE 'Person ' || user_id END AS name,
                CASE WHEN kind = 'Exam_Absences' OR event_id % 5 = 0 THEN '' ELSE 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.com' END AS email,
                CASE WHEN event_type = 'purchase' THEN 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS project
            FROM (SELECT *, CASE WHEN event_type IN ('purchase', 'click') THEN 'Timesheet__WorkedHours' WHEN event_type = 'error' THEN 'Timesheet_Absences' ELSE 'Exam_Absences' END AS kind
                FROM events WHERE event_type <> 'view'))""",
    "file_actions": """
        SELECT a.*, 'Meeting' || a.o_custkey || '.csv' AS file_name,
            13 + n + row_number() OVER (PARTITION BY a.o_custkey ORDER BY activity_id) AS source_row_number,
            CASE WHEN l_orderkey % 78 = 0 THEN '' WHEN l_orderkey % 5 = 0 THEN 'Pér, "' || l_orderkey || '"' ELSE 'Person ' || l_orderkey END AS name,
            CASE WHEN l_orderkey % 78 = 0 OR l_orderkey % 3 = 0 THEN '' ELSE 'P' || l_orderkey || '@Example.com' END AS email,
            CASE WHEN l_orderkey % 78 = 0 THEN '' ELSE 'ID' || l_orderkey END AS ident,
            strftime(join_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS join_text, strftime(leave_ts, '%-m/%-d/%y, %-I:%M:%S %p') AS leave_text,
            seconds // 3600 || 'h ' || seconds % 3600 // 60 || 'm ' || seconds % 60 || 's' AS duration_text
        FROM activities a JOIN sessions s ON s.c_custkey = a.o_custkey""",
}


def sql(body: str) -> str:
    """``body`` with the views it uses, directly or through others, put before it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(view)
                if name not in needed:
                    needed.append(name)

    visit(body)
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {views}\n{body}" if needed else body


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_MATCH = "coalesce(lower(email), participant_id, lower(participant_name))"

_STATUS_COUNTS = "count(*) AS checked_rows, count(*) FILTER (validation_status = 'INVALID') AS failed_rows"


def _quality(source: str, rule: str, table_name: str, column: str, failure: str, details: str) -> str:
    return f"""SELECT run_id, '{rule}' AS rule_name, '{table_name}' AS table_name, {column} AS column_name,
        CASE WHEN failed_rows = 0 THEN 'PASSED' ELSE '{failure}' END AS result_status, checked_rows, failed_rows,
        '{details}' AS details FROM ({source})"""


def _count_check(table_name: str, view: str, name: str, column: str, failed: str) -> str:
    return (
        f"SELECT '{name}' AS rule_name, '{table_name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS checked_rows, count(*) FILTER ({failed}) AS failed_rows FROM {view}"
    )


def _unique_check(table_name: str, view: str, keys: list[str]) -> str:
    name = "UNIQUE_" + "_".join(k.upper() for k in keys)
    joined = ", ".join(keys)
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{name}', '{table_name}', '{','.join(keys)}', CAST(coalesce(sum(n), 0) AS BIGINT), "
        f"CAST(coalesce(sum(n - 1) FILTER ({complete}), 0) AS BIGINT) "
        f"FROM (SELECT {joined}, count(*) AS n FROM {view} GROUP BY {joined})"
    )


def _reference_check(table_name: str, view: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT 'REFERENCE_{column.upper()}', '{table_name}', '{column}', count(*), "
        f"count(*) FILTER ({column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})) "
        f"FROM {view} c"
    )


_EMPLOYEE = "employee_id, employee_name, grade, discipline, line_manager, delivery_unit"

ORACLES: dict[str, str] = {
    "daily_activity": f"""
        SELECT employee_id, employee_name, CAST(full_date AS VARCHAR) AS activity_date, activity_code, activity_name,
            project_name, training_name, CAST(hours AS DOUBLE) AS hours, source_system, source_record_id
        FROM fact JOIN dim_date USING (date_key) JOIN dim_activity_type USING (activity_type_key)
        JOIN dim_employee USING (employee_key) LEFT JOIN dim_project USING (project_key) LEFT JOIN dim_training USING (training_key)
        WHERE employee_id = 'customer#000000008@example.com' AND full_date = DATE '2024-01-05'""",
    "monthly_activity_rank": """
        SELECT *, dense_rank() OVER (PARTITION BY year_number, month_number ORDER BY total_hours DESC) AS monthly_rank FROM (
            SELECT employee_id, employee_name, year_number, month_number, month_name, activity_code,
                CAST(sum(coalesce(hours, 0)) AS DOUBLE) AS total_hours, count(*) AS activity_count
            FROM fact JOIN dim_date USING (date_key) JOIN dim_activity_type USING (activity_type_key)
            LEFT JOIN dim_employee USING (employee_key) GROUP BY ALL)""",
    "training_participation": """
        SELECT employee_id, employee_name, CAST(full_date AS VARCHAR) AS training_date, training_name,
            CAST(hours AS DOUBLE) AS hours, source_record_id
        FROM fact JOIN dim_date USING (date_key) JOIN dim_activity_type USING (activity_type_key)
        LEFT JOIN dim_employee USING (employee_key) LEFT JOIN dim_training USING (training_key)
        WHERE activity_code = 'TRAINING'""",
    "employees_without_activity": f"""
        SELECT {_EMPLOYEE} FROM dim_employee e
        WHERE employee_id <> 'UNKNOWN' AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.employee_key = e.employee_key)""",
    "source_target_counts": """
        SELECT *, source_count - target_count AS difference, CASE WHEN source_count = target_count THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'TRAINING_ATTENDANCE' AS dataset_name, (SELECT count(*) FROM customer) AS source_count,
            (SELECT count(*) FROM stg_participant) AS staging_valid_count,
            (SELECT count(*) FROM stg_participant WHERE validation_status = 'INVALID') AS staging_invalid_count,
            (SELECT count(*) FROM fact WHERE activity_type_key = 3) AS target_count)""",
    "source_target_counts_fixed": """
        SELECT *, source_count - target_count AS difference, CASE WHEN source_count = target_count THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'TRAINING_ATTENDANCE' AS dataset_name,
            (SELECT count(*) FROM stg_participant WHERE validation_status = 'VALID') AS source_count,
            (SELECT count(*) FROM stg_participant WHERE validation_status = 'VALID') AS staging_valid_count,
            (SELECT count(*) FROM stg_participant WHERE validation_status = 'INVALID') AS staging_invalid_count,
            (SELECT count(*) FROM fact WHERE activity_type_key = 3) AS target_count)""",
    "employee_layer_counts": """
        SELECT 'RAW' AS layer_name, count(*) AS row_count, count(*) AS adjusted_count FROM customer
        UNION ALL SELECT 'STAGING', count(*), count(*) FROM employee_rows
        UNION ALL SELECT 'TARGET', count(*), count(*) FILTER (employee_id <> 'UNKNOWN') FROM dim_employee""",
    "employee_null_keys": """
        SELECT participant_raw_id, email AS employee_id, participant_name AS employee_name, 'employee_id' AS missing_column
        FROM stg_participant WHERE email IS NULL
        UNION ALL SELECT participant_raw_id, email, participant_name, 'employee_name' FROM stg_participant WHERE participant_name IS NULL""",
    "attendance_reconciliation": f"""
        SELECT run_id, p.session_raw_id, participant_name, email, participant_id,
            duration_seconds AS participant_reported_seconds, coalesce(activity_seconds, 0) AS calculated_activity_seconds,
            duration_seconds - coalesce(activity_seconds, 0) AS difference_seconds,
            CASE WHEN abs(duration_seconds - coalesce(activity_seconds, 0)) <= 5 THEN 'PASSED' ELSE 'WARNING' END AS reconciliation_status
        FROM stg_participant p LEFT JOIN (
            SELECT session_raw_id, {_MATCH} AS match_key, CAST(sum(duration_seconds) AS BIGINT) AS activity_seconds
            FROM stg_activity WHERE validation_status = 'VALID' GROUP BY 1, 2) a
        ON a.session_raw_id = p.session_raw_id AND a.match_key = {_MATCH.replace('email', 'p.email').replace('participant_id', 'p.participant_id').replace('participant_name', 'p.participant_name')}
        WHERE validation_status = 'VALID'""",
    "calendar": """
        SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, day_number, day_name, week_number, month_number, month_name,
            quarter_number, year_number, is_weekend, count(activity_key) AS activities
        FROM dim_date LEFT JOIN fact USING (date_key) GROUP BY ALL""",
    "activity_types": """
        SELECT activity_type_key, activity_code, activity_name, description, count(activity_key) AS activities
        FROM dim_activity_type LEFT JOIN fact USING (activity_type_key) GROUP BY ALL""",
    "unknown_member": f"""
        SELECT {_EMPLOYEE}, dataset_name, count(activity_key) AS activities
        FROM dim_employee LEFT JOIN fact USING (employee_key) GROUP BY ALL""",
    "stage_employee": """
        SELECT lower(c_name) || '@example.com' AS employee_id, c_name AS employee_name, c_mktsegment AS grade,
            CASE WHEN c_custkey % 9 <> 0 THEN 'DELIVERY' END AS discipline, 'Manager ' || c_nationkey AS line_manager, 'UNIT ' || c_nationkey AS delivery_unit,
            'VALID' AS validation_status, 'CUSTOMER' AS dataset_name, 'customers.csv' AS source_file_name FROM customer""",
    "stage_session": f"""
        SELECT session_raw_id, run_id, session_source_key, meeting_title, reported_participant_count,
            {stamp('start_ts')} AS start_timestamp, {stamp('end_ts')} AS end_timestamp,
            meeting_duration_seconds, average_attendance_seconds, validation_status, validation_message FROM stg_session""",
    "stage_participant": f"""
        SELECT participant_raw_id, session_raw_id, run_id, participant_name, email, participant_id, participant_role,
            {stamp('join_ts')} AS first_join_timestamp, {stamp('leave_ts')} AS last_leave_timestamp, duration_seconds,
            validation_status, validation_message FROM stg_participant""",
    "stage_activity": f"""
        SELECT activity_raw_id, session_raw_id, run_id, participant_name, email, participant_id, participant_role,
            {stamp('join_ts')} AS join_timestamp, {stamp('leave_ts')} AS leave_timestamp, duration_seconds,
            validation_status, validation_message FROM stg_activity""",
    "parse_timestamps": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {stamp('ts')} AS with_seconds, {stamp("date_trunc('minute', ts)")} AS without_seconds
        FROM (SELECT *, l_shipdate + to_seconds(l_orderkey * 7 % 86400) AS ts FROM lineitem)""",
    "parse_durations": """
        SELECT o_orderkey, secs AS full_text, secs // 60 * 60 AS upper_text, secs % 60 AS seconds_only, 0 AS no_number,
            CAST(NULL AS BIGINT) AS blank FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS secs FROM orders)""",
    "normalise_labels": """
        SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) AS label,
            trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS header FROM pages""",
    "match_keys": f"SELECT participant_raw_id, {_MATCH} AS match_key FROM stg_participant",
    "session_keys": "SELECT c_custkey, sha256(lower(c_name) || '|' || c_mktsegment) AS session_source_key FROM customer",
    "upsert_employee": f"""
        SELECT 0 + employee_key AS employee_key, t.employee_id, t.employee_name,
            coalesce(s.grade, t.grade) AS grade, coalesce(s.discipline, t.discipline) AS discipline,
            coalesce(s.line_manager, t.line_manager) AS line_manager, coalesce(s.delivery_unit, t.delivery_unit) AS delivery_unit,
            coalesce(s.dataset_name, t.dataset_name) AS dataset_name
        FROM dim_employee t LEFT JOIN (
            SELECT o_custkey + 1 AS k, max(o_orderpriority) AS grade, 'ORDERS' AS discipline, 'Manager ' || count(*) AS line_manager,
                min(o_orderstatus) AS delivery_unit, 'ORDERS' AS dataset_name FROM orders GROUP BY o_custkey) s ON s.k = t.employee_key
        UNION ALL
        SELECT (SELECT max(employee_key) FROM dim_employee) + row_number() OVER (ORDER BY sha256(lower(s_name) || '@example.com')),
            lower(s_name) || '@example.com', s_name, 'SUPPLIER', 'SUPPLY', 'Manager 0', CAST(s_nationkey AS VARCHAR), 'SUPPLIER'
        FROM supplier""",
    "upsert_training": f"""
        SELECT p_partkey + 1 AS training_key, 'part' || p_partkey AS training_source_key,
            coalesce(meeting_title, p_name) AS training_name,
            {stamp("coalesce(start_ts, TIMESTAMP '2020-01-01 00:00:00')")} AS session_start_timestamp,
            coalesce(reported_participant_count, CASE WHEN meeting_title IS NULL THEN 0 END) AS reported_participant_count,
            'OLD' AS source_system, CAST(p_partkey AS VARCHAR) AS source_record_id
        FROM part LEFT JOIN training_source ON training_source_key = 'part' || p_partkey
        UNION ALL
        SELECT (SELECT max(p_partkey) + 1 FROM part) + row_number() OVER (ORDER BY sha256(training_source_key)), training_source_key,
            meeting_title, {stamp('start_ts')}, reported_participant_count, 'MEETING_ATTENDANCE', CAST(session_raw_id AS VARCHAR)
        FROM training_source WHERE training_source_key NOT IN (SELECT 'part' || p_partkey FROM part)""",
    "upsert_project": """
        SELECT s_suppkey + 1 AS project_key, s_name AS project_name FROM supplier
        UNION ALL SELECT (SELECT max(s_suppkey) + 1 FROM supplier) + row_number() OVER (ORDER BY sha256(p_name)), p_name
        FROM (SELECT DISTINCT p_name FROM part)""",
    "assign_surrogate_keys": """
        SELECT event_id, 1000 + row_number() OVER (ORDER BY sha256(CAST(event_id AS VARCHAR))) AS activity_key FROM events""",
    "restage_by_run": """
        SELECT participant_raw_id, run_id, participant_role FROM stg_participant
        WHERE run_id NOT IN (SELECT run_id FROM stg_session WHERE run_id % 3 = 0)
        UNION ALL SELECT participant_raw_id, run_id, 'AGAIN' FROM stg_participant
        WHERE run_id IN (SELECT run_id FROM stg_session WHERE run_id % 3 = 0)""",
    "new_files_only": """
        SELECT min(doc_id) AS doc_id, sha256(text) AS source_file_hash, any_value(n_chars) AS length FROM documents
        WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id)) GROUP BY sha256(text)""",
    "rejects_participant": """
        SELECT run_id, 'TRAINING_ATTENDANCE' AS pipeline_name, source_file_name AS source_name, source_row_number,
            'INVALID_PARTICIPANT' AS error_code, validation_message AS error_message, raw_record
        FROM stg_participant WHERE validation_status = 'INVALID'""",
    "rejects_activity": """
        SELECT run_id, 'TRAINING_ATTENDANCE' AS pipeline_name, source_file_name AS source_name, source_row_number,
            'INVALID_ACTIVITY' AS error_code, validation_message AS error_message, raw_record
        FROM stg_activity WHERE validation_status = 'INVALID'""",
    "reject_log": """
        SELECT run_id, 'TRAINING_ATTENDANCE' AS pipeline_name, source_file_name AS source_name, source_row_number,
            'INVALID_PARTICIPANT' AS error_code, validation_message AS error_message, raw_record
        FROM stg_participant WHERE validation_status = 'INVALID'
        UNION ALL SELECT run_id, 'TRAINING_ATTENDANCE', source_file_name, source_row_number, 'INVALID_ACTIVITY', validation_message, raw_record
        FROM stg_activity WHERE validation_status = 'INVALID'
        UNION ALL SELECT run_id, 'TRAINING_ATTENDANCE', source_file_name, NULL, 'INVALID_SESSION', validation_message, source_file_name
        FROM stg_session WHERE validation_status = 'INVALID'""",
    "quality_results": "\nUNION ALL ".join([
        _quality(f"SELECT run_id, {_STATUS_COUNTS} FROM stg_participant GROUP BY 1", "TRAINING_PARTICIPANT_VALIDATION",
                 "STAGING.STG_TRAINING_PARTICIPANT", "NULL", "FAILED", "Checks participant identity and duration."),
        _quality(f"SELECT run_id, {_STATUS_COUNTS} FROM stg_activity GROUP BY 1", "TRAINING_ACTIVITY_VALIDATION",
                 "STAGING.STG_TRAINING_ACTIVITY", "NULL", "FAILED", "Checks activity participant and duration."),
        _quality("""SELECT run_id, count(*) AS checked_rows, count(*) FILTER (reported_participant_count <>
                 (SELECT count(*) FROM stg_participant p WHERE p.session_raw_id = s.session_raw_id)) AS failed_rows
                 FROM stg_session s GROUP BY 1""", "REPORTED_VS_PARSED_PARTICIPANTS", "STAGING.STG_TRAINING_SESSION",
                 "'REPORTED_PARTICIPANT_COUNT'", "WARNING", "Compares the summary participant count with parsed participant rows."),
        _quality(f"SELECT run_id, {_STATUS_COUNTS} FROM stg_session GROUP BY 1", "TRAINING_SESSION_VALIDATION",
                 "STAGING.STG_TRAINING_SESSION", "NULL", "FAILED", "Checks meeting title, start and end."),
        _quality("""SELECT run_id, count(*) AS checked_rows, count(*) FILTER (o_orderkey % 17 <> 0 AND o_orderkey % 23 = 0) AS failed_rows
                 FROM stg_participant GROUP BY 1""", "TRAINING_DURATION_UNPARSED", "STAGING.STG_TRAINING_PARTICIPANT",
                 "'DURATION_SECONDS'", "WARNING", "Duration text without hours, minutes or seconds."),
    ]),
    "constraint_violations": "\nUNION ALL ".join([
        _count_check("STG_TRAINING_PARTICIPANT", "stg_participant", "DOMAIN_VALIDATION_STATUS", "validation_status", "validation_status NOT IN ('VALID', 'INVALID')"),
        _count_check("STG_TRAINING_PARTICIPANT", "stg_participant", "NOT_NULL_EMAIL", "email", "email IS NULL"),
        _count_check("STG_TRAINING_PARTICIPANT", "stg_participant", "LENGTH_PARTICIPANT_NAME", "participant_name", "length(participant_name) > 11"),
        _count_check("STG_TRAINING_PARTICIPANT", "stg_participant", "MINIMUM_DURATION_SECONDS", "duration_seconds", "duration_seconds < 1"),
        _count_check("FACT_EMPLOYEE_ACTIVITY", "fact", "MINIMUM_HOURS", "hours", "hours < 0"),
        _count_check("DIM_DATE", "dim_date JOIN fact USING (date_key)", "DOMAIN_IS_WEEKEND", "is_weekend", "is_weekend NOT IN ('Y', 'N')"),
        _unique_check("STG_TRAINING_PARTICIPANT", "stg_participant", ["session_raw_id", "participant_role"]),
        _unique_check("STG_TRAINING_PARTICIPANT", "stg_participant", ["email"]),
        _unique_check("FACT_EMPLOYEE_ACTIVITY", "fact", ["source_system", "source_record_id", "activity_type_key"]),
        _unique_check("DIM_EMPLOYEE", "dim_employee", ["employee_id"]),
        _reference_check("FACT_EMPLOYEE_ACTIVITY", "fact", "employee_key", "dim_employee", "employee_key"),
        _reference_check("FACT_EMPLOYEE_ACTIVITY", "fact", "project_key", "dim_project", "project_key"),
        _reference_check("STG_TRAINING_PARTICIPANT", "stg_participant", "session_raw_id", "stg_session", "session_raw_id"),
    ]),
    "constraint_rejects": """
        SELECT participant_raw_id, 'NOT_NULL_EMAIL' AS rule_name FROM stg_participant WHERE email IS NULL
        UNION ALL SELECT participant_raw_id, 'MINIMUM_DURATION_SECONDS' FROM stg_participant WHERE duration_seconds < 1""",
    "run_status": f"""
        SELECT user_id AS run_id, 'EVENTS' AS pipeline_name,
            CASE WHEN max(ts) FILTER (event_type IN ('purchase', 'signup', 'error')) IS NULL THEN 'RUNNING'
                WHEN arg_max(event_type, ts) FILTER (event_type IN ('purchase', 'signup', 'error')) = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
            {stamp("min(ts) FILTER (event_type IN ('view', 'click'))")} AS start_time,
            {stamp("max(ts) FILTER (event_type IN ('purchase', 'signup', 'error'))")} AS end_time,
            CASE WHEN max(ts) FILTER (event_type IN ('purchase', 'signup', 'error')) IS NULL THEN 0
                ELSE arg_max(CASE WHEN event_type = 'error' THEN 0 ELSE event_id END, ts) FILTER (event_type IN ('purchase', 'signup', 'error')) END AS rows_read,
            CASE WHEN arg_max(event_type, ts) FILTER (event_type IN ('purchase', 'signup', 'error')) = 'error'
                THEN arg_max(props, ts) FILTER (event_type IN ('purchase', 'signup', 'error')) END AS error_message
        FROM events GROUP BY user_id""",
    "run_counts": """
        SELECT c_custkey AS session, 1 + n + coalesce(m, 0) AS rows_read, 1 + n + coalesce(m, 0) AS rows_loaded
        FROM sessions LEFT JOIN (SELECT o_custkey, count(*) AS m FROM activities GROUP BY 1) ON o_custkey = c_custkey""",
    "fact_training": """
        SELECT coalesce(employee_key, 0) AS employee_key, CAST(strftime(join_ts, '%Y%m%d') AS INTEGER) AS date_key, 3 AS activity_type_key,
            s.session_raw_id AS training_key, 'MEETING_ATTENDANCE' AS source_system, session_source_key || '|' || source_row_number AS source_record_id,
            (duration_seconds * 100 + 1800) // 3600 / 100 AS hours, p.run_id AS etl_run_id
        FROM (SELECT * FROM stg_participant WHERE validation_status = 'VALID') p
        JOIN (SELECT session_raw_id, session_source_key FROM stg_session WHERE validation_status = 'VALID') s USING (session_raw_id)
        LEFT JOIN (SELECT lower(email) AS mail, o_orderkey + 1 AS employee_key FROM stg_participant WHERE email IS NOT NULL) e ON e.mail = p.email""",
    "fact_work": """
        SELECT coalesce(k.employee_key, 0) AS employee_key, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, 1 AS activity_type_key,
            s_suppkey AS project_key, 'TIMESHEET' AS source_system, CAST(event_id AS VARCHAR) AS source_record_id,
            CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS hours, 1 AS etl_run_id
        FROM events LEFT JOIN employee_rows k ON k.employee_key = user_id + 1 AND event_type <> 'signup'
        LEFT JOIN supplier ON s_suppkey = user_id AND event_type = 'purchase'""",
    "fact_absence": """
        SELECT coalesce(k.employee_key, 0) AS employee_key, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, 2 AS activity_type_key,
            'TIMESHEET' AS source_system, CAST(event_id AS VARCHAR) AS source_record_id,
            CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS hours, 1 AS etl_run_id
        FROM events LEFT JOIN employee_rows k ON k.employee_key = user_id + 1 AND event_type <> 'signup'""",
    "fact_exam": """
        SELECT coalesce(k.training_key, 0) AS employee_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, 4 AS activity_type_key,
            'EXAM_SCHEDULE' AS source_system, CAST(o_orderkey AS VARCHAR) AS source_record_id, 8.0 AS hours, 1 AS etl_run_id
        FROM orders LEFT JOIN part ON p_partkey = o_custkey
        LEFT JOIN (SELECT lower(p_name) AS n, min(p_partkey) + 1 AS training_key FROM part GROUP BY 1 HAVING count(*) = 1) k ON k.n = lower(p_name)""",
    "employee_master": """
        SELECT employee_name, employee_id, 'JUNIOR' AS grade, 'DATA_ENGINEERING' AS discipline, 'UNKNOWN' AS line_manager, 'DU_DATA' AS delivery_unit
        FROM (SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY file_order, row_number) AS rn FROM (
            SELECT 1 AS file_order, doc_id AS row_number, source AS employee_name, lower(lang) || '@example.com' AS employee_id FROM documents
            UNION ALL SELECT 2, c_custkey, c_name, lower(c_name) || '@example.com' FROM customer
            UNION ALL SELECT 3, o_orderkey, 'Order ' || o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com' END FROM orders)
            WHERE employee_id IS NOT NULL) WHERE rn = 1""",
    "meeting_files": """
        SELECT file_name, CASE c_custkey % 3 WHEN 0 THEN 'utf-8-sig' WHEN 1 THEN 'utf-16-le' ELSE 'cp1252' END AS encoding,
            CASE c_custkey % 3 WHEN 0 THEN ',' WHEN 1 THEN chr(9) ELSE ';' END AS delimiter, CAST(NULL AS VARCHAR) AS error
        FROM file_sessions""",
    "meeting_sessions": """
        SELECT file_name AS source_file_name, session_source_key, 'TRAINING_ATTENDANCE' AS dataset_name, title AS meeting_title_raw,
            CAST(n AS VARCHAR) AS attended_participants_raw, start_text AS start_time_raw, end_text AS end_time_raw,
            '1h 32m 32s' AS meeting_duration_raw, c_custkey % 90 || 'm 0s' AS average_attendance_time_raw FROM file_sessions""",
    "meeting_participants": """
        SELECT file_name AS path, source_row_number, name AS participant_name_raw, join_text AS first_join_raw, leave_text AS last_leave_raw,
            duration_text AS in_meeting_duration_raw, email AS email_raw, ident AS participant_id_raw, role AS role_raw,
            to_json([name, join_text, leave_text, duration_text, email, ident, role]) AS raw_record
        FROM file_people WHERE name || email || ident <> ''""",
    "meeting_activities": """
        SELECT file_name AS path, source_row_number, name AS participant_name_raw, join_text AS join_time_raw, leave_text AS leave_time_raw,
            duration_text AS duration_raw, email AS email_raw, ident AS participant_id_raw, 'attendee' AS role_raw
        FROM file_actions WHERE name || email || ident <> ''""",
    "meeting_rejects": """
        SELECT file_name AS path, source_row_number, 'NO_IDENTITY' AS error_code FROM file_people WHERE name || email || ident = ''
        UNION ALL SELECT file_name, source_row_number, 'NO_IDENTITY' FROM file_actions WHERE name || email || ident = ''""",
    "meeting_fixed_offset": """
        SELECT file_name AS path, source_row_number AS row_number, nullif(name, '') AS name, nullif(email, '') AS email FROM file_people
        UNION ALL SELECT file_name, source_row_number, nullif(name, ''), nullif(email, '') FROM file_actions
        UNION ALL SELECT file_name, n + 12, '3. In-Meeting Activities', NULL FROM file_sessions
        UNION ALL SELECT file_name, n + 13, 'Name', 'Email' FROM file_sessions
        UNION ALL SELECT file_name, n + 11, NULL, NULL FROM file_sessions WHERE c_custkey % 3 = 2""",
    "raw_load": """
        SELECT file_name AS source_file_name, source_row_number, session_raw_id, run_id,
            row_number() OVER (ORDER BY sha256(session_raw_id || chr(1) || source_row_number)) AS participant_raw_id
        FROM file_people JOIN (
            SELECT file_name, row_number() OVER (ORDER BY sha256(session_source_key)) AS session_raw_id,
                100 + row_number() OVER (ORDER BY sha256(file_name)) AS run_id FROM file_sessions) USING (file_name)
        WHERE name || email || ident <> ''""",
    "raw_load_activities": """
        SELECT file_name AS source_file_name, source_row_number, session_raw_id, run_id,
            row_number() OVER (ORDER BY sha256(session_raw_id || chr(1) || source_row_number)) AS activity_raw_id
        FROM file_actions JOIN (
            SELECT file_name, row_number() OVER (ORDER BY sha256(session_source_key)) AS session_raw_id,
                100 + row_number() OVER (ORDER BY sha256(file_name)) AS run_id FROM file_sessions) USING (file_name)
        WHERE name || email || ident <> ''""",
    "raw_load_sessions": """
        SELECT file_name AS source_file_name, row_number() OVER (ORDER BY sha256(session_source_key)) AS session_raw_id,
            100 + row_number() OVER (ORDER BY sha256(file_name)) AS run_id, title AS meeting_title_raw, '1h 32m 32s' AS meeting_duration_raw
        FROM file_sessions""",
    "raw_load_errors": """
        SELECT run_id, 'TRAINING_ATTENDANCE' AS pipeline_name, file_name AS source_name, source_row_number, 'NO_IDENTITY' AS error_code
        FROM (SELECT file_name, source_row_number FROM file_people WHERE name || email || ident = ''
            UNION ALL SELECT file_name, source_row_number FROM file_actions WHERE name || email || ident = '')
        JOIN (SELECT file_name, 100 + row_number() OVER (ORDER BY sha256(file_name)) AS run_id FROM file_sessions) USING (file_name)""",
    "file_hashes": """
        SELECT 'doc' || doc_id AS path, octet_length(encode(text)) AS length,
            len(string_split(text, chr(10))) - CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END AS last_line, 'utf-8-sig' AS encoding,
            min('doc' || doc_id) OVER (PARTITION BY text) AS first_path
        FROM documents WHERE text <> ''""",
    "file_lines": """
        SELECT path, count(*) AS n_lines, sum(length(line)) AS n_chars, arg_max(line, place) AS last_text FROM (
            SELECT 'doc' || doc_id AS path, unnest(string_split(regexp_replace(text, chr(10) || '$', ''), chr(10))) AS line,
                generate_subscripts(string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)), 1) AS place
            FROM documents WHERE text <> '') GROUP BY path""",
    "raw_load_runs": """
        SELECT file_name AS source_name, run_id, 'SUCCESS' AS status, rows_read, rows_read AS rows_loaded, rows_rejected FROM (
            SELECT s.file_name, 100 + row_number() OVER (ORDER BY sha256(s.file_name)) AS run_id,
                1 + coalesce(p.kept, 0) + coalesce(a.kept, 0) AS rows_read, coalesce(p.dropped, 0) + coalesce(a.dropped, 0) AS rows_rejected
            FROM file_sessions s
            LEFT JOIN (SELECT file_name, count(*) FILTER (name || email || ident <> '') AS kept, count(*) FILTER (name || email || ident = '') AS dropped
                FROM file_people GROUP BY 1) p USING (file_name)
            LEFT JOIN (SELECT file_name, count(*) FILTER (name || email || ident <> '') AS kept, count(*) FILTER (name || email || ident = '') AS dropped
                FROM file_actions GROUP BY 1) a USING (file_name))""",
    "file_profile": """
        SELECT 'Employees' || n_nationkey || '.csv' AS file_name, 'utf-8-sig' AS encoding,
            CASE n_nationkey % 4 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9) ELSE '|' END AS delimiter,
            2 AS header_row_number, 7 AS table_width,
            (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 11 <> 0) AS table_rows,
            (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 11 = 0) AS skipped_rows,
            'Emp ID,Full Name,Level,Department,Manager,' || CASE WHEN n_nationkey % 5 = 0 THEN 'Delivery Unit' ELSE 'Region' END || ',Grade' AS columns,
            'Emp ID' AS employee_id, 'Full Name' AS employee_name, 'Grade' AS grade, 'Department' AS discipline, 'Manager' AS line_manager,
            CASE WHEN n_nationkey % 5 = 0 THEN 'Delivery Unit' END AS delivery_unit, n_nationkey % 5 = 0 AS complete_candidate,
            CAST(NULL AS VARCHAR) AS error FROM nation""",
    "mixed_csv_rows": """
        SELECT 'Employees' || c_nationkey || '.csv' AS path, 2 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_number,
            c_custkey % 11 <> 0 AS fits, CASE WHEN c_custkey % 11 = 0 THEN 6 ELSE 7 END AS width, CAST(c_custkey AS VARCHAR) AS first_cell, c_name AS second_cell
        FROM customer""",
    "resolved_columns": """
        SELECT 'Employees' || n_nationkey || '.csv' AS path, 'Emp ID' AS employee_id, 'Full Name' AS employee_name, 'Grade' AS grade,
            'Department' AS discipline, 'Manager' AS line_manager, CASE WHEN n_nationkey % 5 = 0 THEN 'Delivery Unit' END AS delivery_unit
        FROM nation""",
    "unique_headers": """
        SELECT conv_id, turn + 1 AS position, CASE WHEN rn = 1 THEN role ELSE role || '_' || rn END AS header FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM (
                SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'unnamed_column_' || (turn + 1) ELSE role END AS role FROM conversations))""",
    "file_inventory": """
        SELECT 'Meeting' || o_custkey AS file_name, count(*) AS row_count, 3 AS column_count,
            '["key","price","status"]' AS columns, '["int64","float64","object"]' AS column_types,
            to_json(list([CAST(o_orderkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), o_orderstatus] ORDER BY o_orderkey)[:5]) AS first_rows
        FROM orders GROUP BY o_custkey""",
}


_CHOSEN_RUNS = "run_id IN (SELECT run_id FROM stg_session WHERE run_id % 3 = 0)"
ORACLES["cleared_quality"] = f"""
    SELECT * FROM ({ORACLES['quality_results']}) WHERE NOT ({_CHOSEN_RUNS} AND table_name LIKE 'STAGING.STG_TRAINING_P%')"""
ORACLES["cleared_errors"] = f"SELECT * FROM ({ORACLES['reject_log']}) WHERE NOT ({_CHOSEN_RUNS})"
ORACLES["master_csv_roundtrip"] = ORACLES["employee_master"]
ORACLES["master_rejects"] = """
    SELECT 3 AS file_order, o_orderkey AS row_number, 'Order ' || o_orderkey AS employee_name, 'NO_EMAIL' AS error_code
    FROM orders WHERE o_orderkey % 3 = 0"""

_LOOSE = """(SELECT * REPLACE (CASE WHEN activity_key % 13 <> 0 THEN employee_key END AS employee_key,
    CASE WHEN activity_key % 7 = 0 THEN -hours - 1 WHEN activity_key % 11 <> 0 THEN hours END AS hours), activity_key % 5 AS run_id FROM fact)"""
_FACT_CHECKS = [
    *((f"NOT_NULL_{c.upper()}", c, f"{c} IS NULL") for c in ("employee_key", "date_key", "activity_type_key", "source_system", "source_record_id", "hours")),
    ("MINIMUM_HOURS", "hours", "hours < 0"),
]
ORACLES["batch_constraints"] = " UNION ALL ".join(f"""
    SELECT run_id, '{name}' AS rule_name, 'TARGET.FACT_EMPLOYEE_ACTIVITY' AS table_name, '{column.upper()}' AS column_name,
        CASE WHEN count(*) FILTER ({failed}) = 0 THEN 'PASSED' ELSE 'FAILED' END AS result_status,
        count(*) AS checked_rows, count(*) FILTER ({failed}) AS failed_rows, 'Rows that break a constraint of the fact.' AS details
    FROM {_LOOSE} GROUP BY run_id""" for name, column, failed in _FACT_CHECKS)
ORACLES["batch_rejects"] = " UNION ALL ".join(f"""
    SELECT run_id, 'TRAINING_ATTENDANCE' AS pipeline_name, source_system AS source_name, CAST(NULL AS BIGINT) AS source_row_number,
        '{name}' AS error_code, 'The fact breaks {name}' AS error_message, source_record_id AS raw_record
    FROM {_LOOSE} WHERE {failed}""" for name, _, failed in _FACT_CHECKS)

ORACLES["monthly_from_partials"] = ORACLES["monthly_activity_rank"]
ORACLES["known_files"] = """
    SELECT doc_id, sha256(text) AS source_file_hash, coalesce(
        min(CAST(doc_id AS VARCHAR)) FILTER (doc_id IN (SELECT doc_id FROM labels)) OVER (PARTITION BY text),
        min(CAST(doc_id AS VARCHAR)) OVER (PARTITION BY text)) AS loaded_from
    FROM documents"""
ORACLES["records_over_lines"] = """
    SELECT source AS path, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_number, doc_id, sha256(text) AS text_sha256, 3 AS width, false AS unclosed FROM documents"""
ORACLES["plain_table"] = """
    SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN max(o_orderkey) OVER () < 2147483648 THEN 'int' ELSE 'bigint' END
        || ',double,string,date' AS kinds FROM orders"""
ORACLES["input_files"] = """
    SELECT c_nationkey AS nation, true AS is_csv, 29 + sum(octet_length(encode(c_custkey || ',' || c_name || ',' || c_nationkey)) + 1) AS length,
        count(*) + 1 AS n_lines, 'c_custkey,c_name,c_nationkey' AS header FROM customer GROUP BY c_nationkey"""
ORACLES["mixed_csv_table"] = """
    SELECT path, row_number, unnest(['Emp ID', 'Full Name', 'Level', 'Department', 'Manager', CASE WHEN c_nationkey % 5 = 0 THEN 'Delivery Unit' ELSE 'Region' END, 'Grade'])
        AS column_name, unnest([CAST(c_custkey AS VARCHAR), c_name, 'L1', c_mktsegment, 'Boss', CAST(c_nationkey AS VARCHAR), CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR)]) AS cell
    FROM (SELECT *, 'Employees' || c_nationkey || '.csv' AS path, 2 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row_number FROM customer)
    WHERE c_custkey % 11 <> 0"""
ORACLES["timesheet_people"] = """
    SELECT coalesce(min(name) FILTER (kind = 'Timesheet__WorkedHours'), min(name)) AS employee_name, email AS employee_id, 'JUNIOR' AS grade,
        'DATA_ENGINEERING' AS discipline, 'UNKNOWN' AS line_manager, 'DU_DATA' AS delivery_unit
    FROM sheet_rows WHERE fits AND email <> '' AND kind <> 'Exam_Absences' GROUP BY email"""
ORACLES["timesheet_facts"] = """
    SELECT coalesce(CASE WHEN kind = 'Exam_Absences' THEN n.employee_key ELSE e.employee_key END, 0) AS employee_key, date_key,
        CASE kind WHEN 'Timesheet__WorkedHours' THEN 1 WHEN 'Timesheet_Absences' THEN 2 ELSE 4 END AS activity_type_key, project_key,
        CASE kind WHEN 'Exam_Absences' THEN 'EXAM_SCHEDULE' ELSE 'TIMESHEET' END AS source_system, sha256(path) || '|' || row_number AS source_record_id, hours
    FROM sheet_rows r LEFT JOIN dim_employee e ON r.email = e.employee_id AND e.employee_key <> 0 LEFT JOIN dim_employee n ON r.name = n.employee_name AND n.employee_key <> 0
    LEFT JOIN dim_project p ON r.project = p.project_name WHERE code IS NULL AND path <> 'Exam_Absences 5.csv'"""
ORACLES["timesheet_rejects"] = """
    SELECT path, row_number AS source_row_number, code AS error_code, CASE code WHEN 'WIDTH' THEN 'The row has another number of cells than the header.'
        WHEN 'BAD_DAY' THEN 'The day is missing or no date.' ELSE 'The hours are missing or no number from 0 on.' END AS error_message
    FROM sheet_rows WHERE code IS NOT NULL AND path <> 'Exam_Absences 5.csv'
    UNION ALL SELECT DISTINCT path, CAST(NULL AS BIGINT), 'MISSING_COLUMNS', 'The file lacks hours' FROM sheet_rows WHERE path = 'Exam_Absences 5.csv'"""
_TWO_BATCHES = """(SELECT event_id, event_type, user_id, ts, value, event_id % 2 + 1 AS run_id FROM events
    UNION ALL SELECT event_id, event_type, user_id, ts, value, 2 FROM events WHERE (event_id % 2 = 0 AND event_id % 20 = 0) OR (event_id % 2 = 1 AND event_id % 15 = 1))"""
_LISTED = "(event_type <> 'signup')"
ORACLES["facts_after_batches"] = f"""
    SELECT event_id AS record_id, coalesce(employee_id, 'UNKNOWN') AS employee_id, coalesce(grade, 'UNKNOWN') AS grade,
        CASE WHEN event_type = 'purchase' THEN 'Supplier#' || lpad(CAST(events.user_id AS VARCHAR), 9, '0') END AS project_name, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS hours, event_id % 2 + 1 AS run_id, employee_id IS NULL AS is_unknown
    FROM events LEFT JOIN (
        SELECT user_id, employee_id, 'Grade ' || max(run_id) AS grade FROM {_TWO_BATCHES} JOIN employee_rows ON employee_key = user_id + 1 WHERE {_LISTED} GROUP BY ALL
    ) known ON known.user_id = events.user_id AND {_LISTED}"""
ORACLES["batch_uniqueness"] = f"""
    SELECT run_id, 'UNIQUE_SOURCE_SYSTEM_SOURCE_RECORD_ID_ACTIVITY_TYPE_KEY' AS rule_name, 'SOURCE_SYSTEM,SOURCE_RECORD_ID,ACTIVITY_TYPE_KEY' AS column_name,
        CASE WHEN sum(extra) = 0 THEN 'PASSED' ELSE 'FAILED' END AS result_status, count(*) AS checked_rows, CAST(sum(extra) AS BIGINT) AS failed_rows
    FROM (SELECT run_id, CASE WHEN row_number() OVER (PARTITION BY event_id ORDER BY run_id) > 1 THEN 1 ELSE 0 END AS extra FROM {_TWO_BATCHES}) GROUP BY run_id
    UNION ALL SELECT run_id, 'REFERENCE_' || c, c, 'PASSED', count(*), 0 FROM {_TWO_BATCHES}, (VALUES ('DATE_KEY'), ('EMPLOYEE_KEY'), ('PROJECT_KEY'), ('TRAINING_KEY')) t(c) GROUP BY run_id, c"""


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in ORACLES.items()}
