"""Generated and seeded dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall import schemas

# The four activity types and the calendar range.
ACTIVITY_TYPES = [
    (1, "WORK", "Worked Hours", "Hours worked by an employee on a project."),
    (2, "ABSENCE", "Absence", "Employee absence hours such as leave or sickness."),
    (3, "TRAINING", "Training Attendance", "Employee attendance at a training session or meeting."),
    (4, "EXAM", "Exam Activity", "Employee exam-related activity or scheduled exam absence."),
]
CALENDAR_START, CALENDAR_END = "2020-01-01", "2030-12-31"

UNKNOWN_KEY = 0


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included, with its derived parts."""
    day = F.col("full_date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    )
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.dayofmonth(day).alias("day_number"),
        F.upper(F.date_format(day, "EEEE")).alias("day_name"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month_number"),
        F.upper(F.date_format(day, "MMMM")).alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        F.when(F.dayofweek(day).isin(1, 7), "Y").otherwise("N").alias("is_weekend"),
    )


def activity_types(spark: SparkSession) -> DataFrame:
    """The seed rows as an expression, of which Spark knows that it is small."""
    names = schemas.TARGET["dim_activity_type"].names
    rows = [F.struct(*(F.lit(value).alias(name) for name, value in zip(names, row))) for row in ACTIVITY_TYPES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def unknown_employee(spark: SparkSession) -> DataFrame:
    """The member with key 0 that facts without a known employee point at."""
    text = ["employee_id", "employee_name", "grade", "discipline", "line_manager", "delivery_unit"]
    return spark.range(1).select(
        F.lit(UNKNOWN_KEY).cast("bigint").alias("employee_key"),
        *[F.lit("UNKNOWN").alias(name) for name in text],
        F.lit("SYSTEM").alias("dataset_name"),
        F.lit(None).cast("timestamp").alias("process_timestamp"),
    )


def with_unknown(employees: DataFrame) -> DataFrame:
    """Employees plus the unknown member."""
    member = unknown_employee(employees.sparkSession)
    return employees.unionByName(member.select(*employees.columns))
