"""Reports and reconciliations over the star schema.

No join carries a hint: Spark broadcasts a side when its measured size is small, as that of the calendar and the
activity types, and otherwise shuffles, splitting hot keys
at run time. Facts are aggregated before such a join where the report allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.text import match_key
from rollcall.operators.dims import UNKNOWN_KEY
from rollcall.operators.ranking import dense_rank_desc

TOLERANCE_SECONDS = 5
#: Copies of the unknown member in joins with single facts.
SALTS = 64


def _dated(fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame) -> DataFrame:
    """Facts with their calendar day and activity type; facts without either drop out."""
    return fact.join(dim_date, "date_key").join(dim_activity_type, "activity_type_key")


def daily_activity(
    fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame, dim_employee: DataFrame,
    dim_project: DataFrame, dim_training: DataFrame, employee_id: str, day: str,
) -> DataFrame:
    """What one employee did on one day."""
    employee = dim_employee.where(F.col("employee_id") == employee_id)
    date = F.lit(day).cast("date")
    dates = dim_date.where(F.col("full_date") == date)
    # The date key is the date in digits, so the day also prunes the scan of the facts.
    that_day = fact.where(F.col("date_key") == F.date_format(date, "yyyyMMdd").cast("int"))
    return (
        _dated(that_day, dates, dim_activity_type)
        .join(employee, "employee_key")
        .join(dim_project, "project_key", "left")
        .join(dim_training, "training_key", "left")
        .select(
            "employee_id", "employee_name", F.col("full_date").alias("activity_date"),
            "activity_code", "activity_name", "project_name", "training_name", "hours",
            "source_system", "source_record_id",
        )
        .orderBy(
            F.col("activity_date").asc_nulls_last(), F.col("activity_code").asc_nulls_last(),
            F.col("project_name").asc_nulls_last(), F.col("training_name").asc_nulls_last(),
            "source_system", "source_record_id",
        )
    )


def monthly_activity(
    fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame, dim_employee: DataFrame
) -> DataFrame:
    """R2 before ranking: hours and count per employee, month and activity code.

    Facts are summed per employee key first, so the join with employees sees one row per key,
    month and code; a key with a third of all facts is combined on the map side.
    """
    return _named_months(monthly_partials(fact, dim_date, dim_activity_type), dim_employee)


_MONTH = ("employee_key", "year_number", "month_number", "month_name", "activity_code")


def monthly_partials(fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame) -> DataFrame:
    """Hours and count per employee key, month and code of some facts, such as those of one batch. Partials add up."""
    return _dated(fact, dim_date, dim_activity_type).groupBy(*_MONTH).agg(
        F.sum(F.coalesce("hours", F.lit(0).cast("decimal(18,2)"))).cast("decimal(28,2)").alias("hours"),
        F.count(F.lit(1)).alias("activity_count"),
    )


def fold_partials(partials: DataFrame) -> DataFrame:
    """The partials of several batches as one: a row per employee key, month and code."""
    return partials.groupBy(*_MONTH).agg(F.sum("hours").cast("decimal(28,2)").alias("hours"), F.sum("activity_count").alias("activity_count"))


def _named_months(per_key: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Partials with the employee's names in place of the key; keys that nobody knows are one row."""
    names = dim_employee.select("employee_key", "employee_id", "employee_name")
    return (
        per_key.join(names, "employee_key", "left")
        .groupBy("employee_id", "employee_name", "year_number", "month_number", "month_name", "activity_code")
        .agg(
            F.sum("hours").cast("decimal(20,2)").alias("total_hours"),
            F.sum("activity_count").alias("activity_count"),
        )
    )


def monthly_activity_rank(
    fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame, dim_employee: DataFrame
) -> DataFrame:
    """R2: monthly activity with a dense rank by hours within the month."""
    return _ranked_months(monthly_activity(fact, dim_date, dim_activity_type, dim_employee))


def monthly_rank_from_partials(partials: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """R2 out of the partials of all batches: the facts are not read again, and late facts only add a partial."""
    return _ranked_months(_named_months(partials, dim_employee))


def _ranked_months(monthly: DataFrame) -> DataFrame:
    ranked = dense_rank_desc(
        monthly, ["year_number", "month_number"], "total_hours", "monthly_rank", weight="activity_count"
    )
    return ranked.select(
        "employee_id", "employee_name", "year_number", "month_number", "month_name",
        "activity_code", "total_hours", "activity_count", "monthly_rank",
    ).orderBy(
        "year_number", "month_number", F.col("employee_name").asc_nulls_last(), "activity_code",
        F.col("employee_id").asc_nulls_last(),
    )


def training_participation(
    fact: DataFrame, dim_date: DataFrame, dim_activity_type: DataFrame, dim_employee: DataFrame, dim_training: DataFrame
) -> DataFrame:
    """Who attended which training, when and for how long."""
    training = dim_activity_type.where(F.col("activity_code") == "TRAINING")
    # All people that are not known have one key: that member is repeated, and its facts are spread over the copies.
    unknown = F.col("employee_key") == UNKNOWN_KEY
    facts = _dated(fact, dim_date, training).withColumn(
        "_salt", F.when(unknown, F.pmod(F.xxhash64("source_record_id"), F.lit(SALTS))).otherwise(F.lit(0))
    )
    copies = F.when(unknown, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    members = dim_employee.select("employee_key", "employee_id", "employee_name", F.explode(copies).alias("_salt"))
    # Facts without a training match none; they get keys below zero, so that they do not meet in one task.
    spread = F.coalesce("training_key", -1 - F.pmod(F.xxhash64("source_record_id"), F.lit(1_000_000)))
    names = dim_training.select(F.col("training_key").alias("_training"), "training_name")
    return (
        facts.join(members, ["employee_key", "_salt"], "left")
        .withColumn("_training", spread)
        .join(names, "_training", "left")
        .select(
            "employee_id", "employee_name", F.col("full_date").alias("training_date"),
            "training_name", "hours", "source_record_id",
        )
        .orderBy(
            F.col("training_date").asc_nulls_last(), F.col("employee_name").asc_nulls_last(),
            F.col("training_name").asc_nulls_last(), "source_record_id",
        )
    )


def employees_without_activity(dim_employee: DataFrame, fact: DataFrame) -> DataFrame:
    """Employees with no fact at all, the unknown member left out."""
    active = fact.select("employee_key").distinct()
    return (
        dim_employee.where(F.col("employee_id") != "UNKNOWN")
        .join(active, "employee_key", "left_anti")
        .select("employee_id", "employee_name", "grade", "discipline", "line_manager", "delivery_unit")
        .orderBy(F.col("employee_name").asc_nulls_last(), "employee_id")
    )


def source_target_counts(
    session_raw: DataFrame, participants: DataFrame, fact: DataFrame, dim_activity_type: DataFrame,
    *, same_grain: bool = False,
) -> DataFrame:
    """Row counts of the layers in one row.

    The plain form keeps the report's own counts: sessions at the source, every staged participant
    as valid. ``same_grain`` counts VALID participants at the source and in staging instead, which
    is the grain of the training facts. Source and target then agree when the load is complete.
    """
    training = dim_activity_type.where(F.col("activity_code") == "TRAINING").select("activity_type_key")
    target = fact.join(training, "activity_type_key", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    invalid = F.col("validation_status") == "INVALID"
    staged = participants.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(invalid).alias("invalid"), F.count_if(~invalid).alias("valid")
    )
    valid = F.col("valid") if same_grain else F.col("all")
    sessions = session_raw.agg(F.count(F.lit(1)).alias("n"))
    source = F.col("valid") if same_grain else sessions.scalar()
    return (
        staged.select(
            F.lit("TRAINING_ATTENDANCE").alias("dataset_name"),
            source.alias("source_count"),
            valid.alias("staging_valid_count"),
            F.col("invalid").alias("staging_invalid_count"),
            target.scalar().alias("target_count"),
        )
        .withColumn("difference", F.col("source_count") - F.col("target_count"))
        .withColumn("status", F.when(F.col("difference") == 0, "PASS").otherwise("FAIL"))
    )


def employee_layer_counts(raw: DataFrame, staging: DataFrame, target: DataFrame) -> DataFrame:
    """Rows per layer; the adjusted count leaves out the unknown member of the target."""
    def layer(df: DataFrame, name: str, known) -> DataFrame:
        return df.agg(
            F.lit(name).alias("layer_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(known).alias("adjusted_count"),
        )

    known = F.col("employee_id").isNull() | (F.col("employee_id") != "UNKNOWN")
    return (
        layer(raw, "RAW", F.lit(True))
        .unionByName(layer(staging, "STAGING", F.lit(True)))
        .unionByName(layer(target, "TARGET", known))
    )


def employee_null_keys(employees: DataFrame) -> DataFrame:
    """Rows without id and rows without name; a row lacking both is listed twice."""
    reasons = F.filter(
        F.array(
            F.when(F.col("employee_id").isNull(), F.lit("employee_id")),
            F.when(F.col("employee_name").isNull(), F.lit("employee_name")),
        ),
        lambda reason: reason.isNotNull(),
    )
    missing = F.col("employee_id").isNull() | F.col("employee_name").isNull()
    return employees.where(missing).withColumn("missing_column", F.explode(reasons))


def attendance_reconciliation(
    participants: DataFrame, activities: DataFrame, tolerance: int = TOLERANCE_SECONDS
) -> DataFrame:
    """Reported attendance of a participant against the sum of their activities."""
    valid = F.col("validation_status") == "VALID"
    seconds = (
        activities.where(valid)
        .groupBy("session_raw_id", match_key().alias("match_key"))
        .agg(F.sum("duration_seconds").alias("activity_seconds"))
    )
    calculated = F.coalesce("activity_seconds", F.lit(0))
    difference = F.col("duration_seconds") - calculated
    return (
        participants.where(valid)
        .withColumn("match_key", match_key())
        .join(seconds, ["session_raw_id", "match_key"], "left")
        .select(
            "run_id", "session_raw_id", "participant_name", "email", "participant_id",
            F.col("duration_seconds").alias("participant_reported_seconds"),
            calculated.alias("calculated_activity_seconds"),
            difference.alias("difference_seconds"),
            F.when(F.abs(difference) <= tolerance, "PASSED").otherwise("WARNING").alias("reconciliation_status"),
        )
        .orderBy("run_id", F.col("participant_name").asc_nulls_last(), "session_raw_id", "email", "participant_id")
    )
