"""Every query by name: ``(spark, sf_dir) -> DataFrame``. Dates and times are shown as text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import views
from checks.views import stamp, table
from rollcall.functions.clock import parse_duration, with_timestamps
from rollcall.functions.text import match_key, normalise_header, normalise_label, session_key
from rollcall import schemas
from rollcall.operators import audit, dims, facts, known, loads, rules, stage, upsert
from rollcall.operators.ranking import number_by_hash
from rollcall.plans import batch, quality, reports, timesheets
from rollcall.sources import master, meetings, profiles, tables
from rollcall.sources.files import dealt_lines, decode_lines, describe_byte_lines, find_input_files, read_files, read_table, whole_lines, with_line_facts
from rollcall.sources.records import read_records
from rollcall.storage import land

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- reports --------------------------------------------------------------------------------


@query
def daily_activity(spark, sf):
    report = reports.daily_activity(
        **views.star(spark, sf), dim_project=views.dim_project(spark, sf), dim_training=views.dim_training(spark, sf),
        employee_id="customer#000000008@example.com", day="2024-01-05",
    )
    return report.withColumns({"activity_date": F.col("activity_date").cast("string"), "hours": F.col("hours").cast("double")})


@query
def monthly_activity_rank(spark, sf):
    report = reports.monthly_activity_rank(**views.star(spark, sf))
    return report.withColumn("total_hours", F.col("total_hours").cast("double"))


@query
def monthly_from_partials(spark, sf):
    """The monthly rank out of the sums that three batches of facts have left in a store."""
    star, store = views.star(spark, sf), loads.Store(spark, storage_folder(spark), digits=1)
    schema = schemas.TARGET["fact_month"]
    for third in range(3):
        number = store.begin()
        months = reports.monthly_partials(star["fact"].where(F.col("activity_key") % 3 == third), star["dim_date"], star["dim_activity_type"])
        store.write_batch("fact_month", months.select(*schema.names), number)
        store.commit(number)
    report = reports.monthly_rank_from_partials(reports.fold_partials(store.rows("fact_month", schema)), star["dim_employee"])
    return report.withColumn("total_hours", F.col("total_hours").cast("double"))


@query
def training_participation(spark, sf):
    report = reports.training_participation(**views.star(spark, sf), dim_training=views.dim_training(spark, sf))
    return report.withColumns({"training_date": F.col("training_date").cast("string"), "hours": F.col("hours").cast("double")})


@query
def employees_without_activity(spark, sf):
    return reports.employees_without_activity(views.dim_employee(spark, sf), views.fact(spark, sf))


def staged_sessions(spark, sf):
    return stage.stage_sessions(views.session_raw(spark, sf))


def staged_participants(spark, sf):
    return stage.stage_participants(views.participant_raw(spark, sf))


def staged_activities(spark, sf):
    return stage.stage_activities(views.activity_raw(spark, sf))


@query
def source_target_counts(spark, sf):
    return reports.source_target_counts(
        views.session_raw(spark, sf), staged_participants(spark, sf), views.fact(spark, sf), dims.activity_types(spark)
    )


@query
def source_target_counts_fixed(spark, sf):
    return reports.source_target_counts(
        views.session_raw(spark, sf), staged_participants(spark, sf), views.fact(spark, sf), dims.activity_types(spark),
        same_grain=True,
    )


@query
def employee_layer_counts(spark, sf):
    employees = views.employee_rows(spark, sf)
    return reports.employee_layer_counts(employee_master_raw(spark, sf), stage.stage_employees(
        employees.withColumn("source_file_name", F.lit("customers.csv"))
    ), dims.with_unknown(employees))


@query
def employee_null_keys(spark, sf):
    people = staged_participants(spark, sf).select(
        "participant_raw_id", F.col("email").alias("employee_id"), F.col("participant_name").alias("employee_name")
    )
    return reports.employee_null_keys(people)


@query
def attendance_reconciliation(spark, sf):
    return reports.attendance_reconciliation(staged_participants(spark, sf), staged_activities(spark, sf))


# --- dimensions -----------------------------------------------------------------------------


def _activities_of(dimension: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, key, "left").withColumn("activities", F.coalesce("n", F.lit(0))).drop("n")


@query
def calendar(spark, sf):
    days = _activities_of(dims.calendar(spark), views.fact(spark, sf), "date_key")
    return days.withColumn("full_date", F.col("full_date").cast("string"))


@query
def activity_types(spark, sf):
    return _activities_of(dims.activity_types(spark), views.fact(spark, sf), "activity_type_key")


@query
def unknown_member(spark, sf):
    members = _activities_of(views.dim_employee(spark, sf), views.fact(spark, sf), "employee_key")
    return members.drop("employee_key", "process_timestamp")


# --- staging --------------------------------------------------------------------------------


def employee_master_raw(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com ")).alias("employee_id"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("employee_name"),
        F.lower("c_mktsegment").alias("grade"),
        F.when(F.col("c_custkey") % 9 == 0, " ").otherwise(" delivery").alias("discipline"),
        F.concat(F.lit(" Manager "), F.col("c_nationkey").cast("string")).alias("line_manager"),
        F.concat(F.lit("unit "), F.col("c_nationkey").cast("string")).alias("delivery_unit"),
        F.lit("CUSTOMER").alias("dataset_name"), F.lit("customers.csv").alias("source_file_name"),
        F.lit(None).cast("timestamp").alias("process_timestamp"),
    )


@query
def stage_employee(spark, sf):
    return stage.stage_employees(employee_master_raw(spark, sf)).drop("validation_message", "process_timestamp")


@query
def stage_session(spark, sf):
    return staged_sessions(spark, sf).withColumns({c: stamp(c) for c in ("start_timestamp", "end_timestamp")})


@query
def stage_participant(spark, sf):
    return staged_participants(spark, sf).withColumns({c: stamp(c) for c in ("first_join_timestamp", "last_leave_timestamp")})


@query
def stage_activity(spark, sf):
    return staged_activities(spark, sf).withColumns({c: stamp(c) for c in ("join_timestamp", "leave_timestamp")})


@query
def parse_timestamps(spark, sf):
    """U1 on every line item."""
    ts = F.col("l_shipdate") + F.make_dt_interval(secs=(F.col("l_orderkey") * 7 % 86400).cast("decimal(18,6)"))
    lines = table(spark, sf, "lineitem").withColumn("ts", ts).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat(F.lit(" "), views.clock_text("ts")).alias("long_text"), views.clock_text("ts", False).alias("short_text"),
    )
    timed = with_timestamps(lines, {"with_seconds": "long_text", "without_seconds": "short_text"})
    return timed.drop("long_text", "short_text").withColumns({c: stamp(c) for c in ("with_seconds", "without_seconds")})


@query
def parse_durations(spark, sf):
    """U2 on every order."""
    orders = table(spark, sf, "orders").withColumn("secs", F.floor("o_totalprice"))
    h, m, s = F.floor(F.col("secs") / 3600), F.floor(F.col("secs") % 3600 / 60), F.col("secs") % 60
    return orders.select(
        "o_orderkey",
        parse_duration(F.format_string("%dh %dm %ds", h, m, s)).alias("full_text"),
        parse_duration(F.format_string(" %dH%d M", h, m)).alias("upper_text"),
        parse_duration(F.format_string("%d sec", s)).alias("seconds_only"),
        parse_duration(F.col("o_orderpriority")).alias("no_number"),
        parse_duration(F.lit("  ")).alias("blank"),
    )


@query
def normalise_labels(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", normalise_label("url").alias("label"), normalise_header("url").alias("header")
    )


@query
def match_keys(spark, sf):
    return staged_participants(spark, sf).select("participant_raw_id", match_key().alias("match_key"))


@query
def session_keys(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        session_key(F.concat(F.lit("\t "), F.col("c_name")), F.concat(F.col("c_mktsegment"), F.lit(" \n"))).alias("session_source_key"),
    )


# --- loads ----------------------------------------------------------------------------------


@query
def upsert_employee(spark, sf):
    ordered = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderpriority").alias("grade"), F.lit("ORDERS").alias("discipline"),
        F.concat(F.lit("Manager "), F.count(F.lit(1)).cast("string")).alias("line_manager"),
        F.min("o_orderstatus").alias("delivery_unit"), F.lit("ORDERS").alias("dataset_name"),
    )
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("employee_name"))
    known = customer.join(ordered, customer.c_custkey == ordered.o_custkey).drop("c_custkey", "o_custkey")
    fresh = table(spark, sf, "supplier").select(
        F.col("s_name").alias("employee_name"), F.lit("SUPPLIER").alias("grade"), F.lit("SUPPLY").alias("discipline"),
        F.lit("Manager 0").alias("line_manager"), F.col("s_nationkey").cast("string").alias("delivery_unit"),
        F.lit("SUPPLIER").alias("dataset_name"),
    )
    source = known.unionByName(fresh).select(
        F.concat(F.lower("employee_name"), F.lit("@example.com")).alias("employee_id"), "*",
        F.lit("VALID").alias("validation_status"), F.lit(None).cast("timestamp").alias("process_timestamp"),
    )
    return upsert.upsert_employees(views.dim_employee(spark, sf), source).drop("process_timestamp")


def training_source(spark, sf):
    """Staged meetings; those with more than ten participants have the key of a part."""
    known = F.concat(F.lit("part"), F.col("session_raw_id").cast("string"))
    key = F.when(F.col("reported_participant_count") > 10, known).otherwise(F.col("session_source_key"))
    return staged_sessions(spark, sf).withColumn("session_source_key", key)


@query
def upsert_training(spark, sf):
    key = F.col("p_partkey")
    target = table(spark, sf, "part").select(
        (key + 1).alias("training_key"), F.concat(F.lit("part"), key.cast("string")).alias("training_source_key"),
        F.col("p_name").alias("training_name"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("session_start_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("session_end_timestamp"), F.lit(0).cast("bigint").alias("reported_participant_count"),
        F.lit("OLD").alias("source_system"), key.cast("string").alias("source_record_id"),
        F.lit(None).cast("timestamp").alias("load_timestamp"),
    )
    merged = upsert.upsert_trainings(target, training_source(spark, sf))
    return merged.withColumn("session_start_timestamp", stamp("session_start_timestamp")).drop("session_end_timestamp", "load_timestamp")


@query
def upsert_project(spark, sf):
    target = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1).alias("project_key"), F.col("s_name").alias("project_name"))
    return upsert.upsert_projects(target, table(spark, sf, "part").select(F.col("p_name").alias("project_name")))


@query
def assign_surrogate_keys(spark, sf):
    events = table(spark, sf, "events").select("event_id")
    return number_by_hash(events, ["event_id"], "activity_key", start=1000)


@query
def restage_by_run(spark, sf):
    """A third of the runs is staged again."""
    staged = staged_participants(spark, sf).select("participant_raw_id", "run_id", "participant_role")
    chosen = staged_sessions(spark, sf).where("run_id % 3 = 0").select("run_id").distinct()
    again = staged.join(chosen, "run_id", "left_semi").withColumn("participant_role", F.lit("AGAIN"))
    folder = f"{storage_folder(spark)}/staged"
    for rows in (staged, again):  # the folders of a run are written anew where they lie
        loads.replace_partitions(rows, folder, "run_id")
    return spark.read.schema(staged.schema).parquet(folder)


@query
def cleared_quality(spark, sf):
    """Quality rows left when a third of the runs is cleared for one table prefix."""
    results = quality_results(spark, sf)
    chosen = staged_sessions(spark, sf).where("run_id % 3 = 0")
    return upsert.clear_quality(results, chosen, "STAGING.STG_TRAINING_P")


@query
def cleared_errors(spark, sf):
    errors = reject_log(spark, sf)
    chosen = staged_sessions(spark, sf).where("run_id % 3 = 0")
    return upsert.clear_errors(errors, chosen, quality.PIPELINE)


@query
def new_files_only(spark, sf):
    """Documents as files; those with labels are loaded already."""
    documents = table(spark, sf, "documents").select(
        "doc_id", F.col("n_chars").alias("length"), F.sha2(F.col("text").cast("binary"), 256).alias("source_file_hash")
    )
    loaded = documents.join(table(spark, sf, "labels"), "doc_id", "left_semi")
    return upsert.new_files(documents, loaded, order="doc_id")


@query
def known_files(spark, sf):
    """Documents as files: those with a label are known to a store, the others are looked up and remembered."""
    documents = table(spark, sf, "documents").select(F.sha2("text", 256).alias("source_file_hash"), F.col("doc_id").cast("string").alias("session_source_key"), "doc_id")
    store = loads.Store(spark, storage_folder(spark), digits=1)
    number = store.begin()
    labelled = documents.join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    # Of files with one content the first is the one that is loaded.
    first = labelled.groupBy("source_file_hash").agg(F.min("session_source_key").alias("session_source_key"))
    known.remember(store, number, "known_hash", "source_file_hash", first)
    store.commit(number)
    fresh = documents.join(known.loaded_meetings(store, documents), "source_file_hash", "left_anti")
    number = store.begin()
    known.remember(store, number, "known_hash", "source_file_hash", fresh.groupBy("source_file_hash").agg(F.min("session_source_key").alias("session_source_key")))
    store.commit(number)
    held = known.loaded_meetings(store, documents).select("source_file_hash", F.col("session_source_key").alias("loaded_from"))
    return documents.select("doc_id", "source_file_hash").join(held, "source_file_hash")


def stored_batches(spark, sf, batches: int = 2) -> loads.Store:
    """Events as timesheet rows, loaded in several batches; the last one repeats a tenth of the first and some of its own."""
    store = loads.Store(spark, storage_folder(spark), digits=1)
    rows = timesheet(spark, sf).withColumn("batch", F.col("record_id") % batches)
    people = views.employee_rows(spark, sf).select(*schemas.TARGET["dim_employee"].names).drop("employee_key").withColumns(
        {"validation_status": F.lit("VALID"), "validation_message": F.lit(None).cast("string"), "source_file_name": F.lit("people")}
    )
    for k in range(batches):
        number = store.begin()
        own = rows.where(F.col("batch") == k).withColumn("run_id", F.lit(k + 1))
        if k == batches - 1:
            again = rows.where(((F.col("batch") == 0) & (F.col("record_id") % 20 == 0)) | ((F.col("batch") == k) & (F.col("record_id") % 15 == 1)))
            own = own.unionByName(again.withColumn("run_id", F.lit(k + 1)))
        listed = people.join(own.select(F.lower(F.trim("email")).alias("employee_id")).distinct(), "employee_id", "left_semi")
        batch.merge_employees(store, number, land(listed.withColumn("grade", F.concat(F.lit("Grade "), F.lit(str(number)))), "listed"))
        batch.merge_projects(store, number, own.where("project_name IS NOT NULL").select("project_name"))
        target = schemas.TARGET
        employees, projects = (store.version(t, target[t], number) for t in ("dim_employee", "dim_project"))
        batch.add_facts(store, facts.work_facts(own.drop("batch"), employees, projects), number, "work")
        batch.commit(store, number)
    return store


@query
def facts_after_batches(spark, sf):
    """Facts of two batches with the dimensions as they are after both."""
    store, target = stored_batches(spark, sf), schemas.TARGET
    employees = store.version("dim_employee", target["dim_employee"]).select("employee_key", "employee_id", "grade")
    stored = store.rows("fact_employee_activity", target["fact_employee_activity"])
    projects = store.version("dim_project", target["dim_project"])
    found = stored.join(employees, "employee_key").join(projects, "project_key", "left")
    return found.select(
        F.col("source_record_id").cast("bigint").alias("record_id"), "employee_id", "grade", "project_name", "date_key", F.col("hours").cast("double").alias("hours"),
        F.col("etl_run_id").alias("run_id"), (F.col("employee_key") == 0).alias("is_unknown"),
    )


@query
def batch_uniqueness(spark, sf):
    """What the load says of keys and references of both batches."""
    results = stored_batches(spark, sf).rows("data_quality_result", schemas.CONTROL["data_quality_result"])
    return results.where("rule_name LIKE 'UNIQUE%' OR rule_name LIKE 'REFERENCE%'").select("run_id", "rule_name", "column_name", "result_status", "checked_rows", "failed_rows")


# --- quality and audit ----------------------------------------------------------------------


@query
def rejects_participant(spark, sf):
    return quality.participant_rejects(staged_participants(spark, sf), views.participant_raw(spark, sf))


@query
def rejects_activity(spark, sf):
    return quality.activity_rejects(staged_activities(spark, sf), views.activity_raw(spark, sf))


@query
def reject_log(spark, sf):
    sessions = quality.session_rejects(staged_sessions(spark, sf), views.session_raw(spark, sf))
    return quality.reject_log(rejects_participant(spark, sf), rejects_activity(spark, sf), sessions)


@query
def quality_results(spark, sf):
    return quality.quality_results(
        staged_sessions(spark, sf), staged_participants(spark, sf), staged_activities(spark, sf), views.participant_raw(spark, sf)
    )


@query
def constraint_violations(spark, sf):
    people, fact, employees = staged_participants(spark, sf), views.fact(spark, sf), views.dim_employee(spark, sf)
    days = dims.calendar(spark).join(fact.select("date_key"), "date_key")
    participant, activity = "STG_TRAINING_PARTICIPANT", "FACT_EMPLOYEE_ACTIVITY"
    checked = [
        rules.check_rows(people, participant, [
            rules.domain("validation_status", "VALID", "INVALID"), rules.not_null("email"),
            rules.max_length("participant_name", 11), rules.minimum("duration_seconds", 1),
        ]),
        rules.check_rows(fact, activity, [rules.minimum("hours", 0)]),
        rules.check_rows(days, "DIM_DATE", [rules.domain("is_weekend", "Y", "N")]),
        rules.check_unique(people, participant, ["session_raw_id", "participant_role"]),
        rules.check_unique(people, participant, ["email"]),
        rules.check_unique(fact, activity, ["source_system", "source_record_id", "activity_type_key"]),
        rules.check_unique(employees, "DIM_EMPLOYEE", ["employee_id"]),
        rules.check_reference(fact, activity, "employee_key", employees, "employee_key"),
        rules.check_reference(fact, activity, "project_key", views.dim_project(spark, sf), "project_key"),
        rules.check_reference(people, participant, "session_raw_id", staged_sessions(spark, sf), "session_raw_id"),
    ]
    return reduce(DataFrame.unionByName, checked)


def loose_facts(spark, sf) -> DataFrame:
    """Facts of which some lack an employee or hours, or have negative ones."""
    key = F.col("activity_key")
    return views.fact(spark, sf).withColumns({
        "employee_key": F.when(key % 13 != 0, F.col("employee_key")), "etl_run_id": key % 5,
        "hours": F.when(key % 7 == 0, -F.col("hours") - 1).when(key % 11 != 0, F.col("hours")),
    })


@query
def batch_constraints(spark, sf):
    return quality.fact_constraints(loose_facts(spark, sf))


@query
def batch_rejects(spark, sf):
    return quality.fact_rejects(loose_facts(spark, sf))


@query
def constraint_rejects(spark, sf):
    checks = [rules.not_null("email"), rules.minimum("duration_seconds", 1)]
    return rules.failing_rows(staged_participants(spark, sf), checks).select("participant_raw_id", "rule_name")


@query
def run_status(spark, sf):
    """Events as the run log: views and clicks open a run, purchases, signups and errors close it."""
    kind = F.col("event_type")
    runs = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.lit("EVENTS").alias("pipeline_name"), kind.alias("source_name"), "event_id", "ts", "props"
    )
    of = lambda *kinds: runs.where(F.col("source_name").isin(*kinds))
    log = (
        audit.start_runs(of("view", "click"), F.col("ts"))
        .unionByName(audit.finish_success(of("purchase", "signup"), F.col("event_id"), F.col("event_id"), 0, F.col("ts")))
        .unionByName(audit.finish_failed(of("error"), F.col("props"), at=F.col("ts")))
    )
    return audit.run_states(log).select(
        "run_id", "pipeline_name", "status", stamp("start_time").alias("start_time"), stamp("end_time").alias("end_time"),
        "rows_read", "error_message",
    )


@query
def run_counts(spark, sf):
    by_session = lambda df, key: df.select(F.col(key).alias("session"))
    return audit.run_counts(
        by_session(views.sessions(spark, sf), "c_custkey"), by_session(views.participants(spark, sf), "o_custkey"),
        by_session(views.activities(spark, sf), "o_custkey"), "session",
    )


# --- facts ----------------------------------------------------------------------------------


def _shown(fact: DataFrame, *without: str) -> DataFrame:
    return fact.withColumn("hours", F.col("hours").cast("double")).drop(*without)


@query
def fact_training(spark, sf):
    raw = views.participant_raw(spark, sf)
    sessions = staged_sessions(spark, sf)
    trainings = sessions.select(F.col("session_source_key").alias("training_source_key"), F.col("session_raw_id").alias("training_key"))
    employees = staged_participants(spark, sf).where(F.col("email").isNotNull()).select(
        F.upper("email").alias("employee_id"), F.col("participant_raw_id").alias("employee_key")
    )
    return _shown(facts.training_facts(staged_participants(spark, sf), raw, sessions, trainings, employees), "project_key")


def timesheet(spark, sf):
    kind = F.col("event_type")
    email = F.when(kind != "signup", F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit("@example.com")))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("record_id"), email.alias("email"),
        F.when(kind == "purchase", F.concat(F.lit("Supplier#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))).alias("project_name"),
        F.col("ts").alias("work_date"), F.col("value").alias("hours"), F.lit(1).alias("run_id"),
    )


@query
def fact_work(spark, sf):
    return _shown(facts.work_facts(timesheet(spark, sf), views.dim_employee(spark, sf), views.dim_project(spark, sf)), "training_key")


@query
def fact_absence(spark, sf):
    absences = timesheet(spark, sf).drop("project_name")
    return _shown(facts.absence_facts(absences, views.dim_employee(spark, sf)), "training_key", "project_key")


@query
def fact_exam(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    orders = table(spark, sf, "orders")
    exams = orders.join(part, orders.o_custkey == part.p_partkey, "left").select(
        F.col("o_orderkey").alias("record_id"), F.upper("p_name").alias("employee_name"), F.col("o_orderdate").alias("exam_date"),
        F.lit(8).alias("hours"), F.lit(1).alias("run_id"),
    )
    employees = part.select((F.col("p_partkey") + 1).alias("employee_key"), F.col("p_name").alias("employee_name"))
    return _shown(facts.exam_facts(exams, employees), "training_key", "project_key")


# --- employee master ------------------------------------------------------------------------


def people_lists(spark, sf) -> list[DataFrame]:
    documents = table(spark, sf, "documents").withColumn("mail", F.concat(F.lit(" "), F.upper("lang"), F.lit("@Example.com")))
    customers = table(spark, sf, "customer").withColumn("mail", F.concat(F.col("c_name"), F.lit("@example.com\t")))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("@example.com"))).alias("mail"),
    )
    return [
        master.people_list(documents, "source", "mail", "doc_id", 1),
        master.people_list(customers, "c_name", "mail", "c_custkey", 2),
        master.people_list(orders, "name", "mail", "o_orderkey", 3),
    ]


@query
def employee_master(spark, sf):
    return master.employee_master(people_lists(spark, sf))


@query
def master_rejects(spark, sf):
    return master.rejected_people(people_lists(spark, sf))


@query
def master_csv_roundtrip(spark, sf):
    """The employee master written as delimited files and read again."""
    built = employee_master(spark, sf)
    folder = f"{storage_folder(spark)}/master"
    loads.write_csv(built, folder)
    return loads.read_csv(spark, folder, built.schema)


def storage_folder(spark) -> str:
    import uuid

    from rollcall.storage import shared_folder

    return f"{shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"


# --- files ----------------------------------------------------------------------------------


def meeting_bytes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The rendered meetings as files: their facts and their byte lines."""
    raw = with_line_facts(whole_lines(*views.meeting_byte_lines(spark, sf)), meetings.LABEL_WORDS)
    raw = dealt_lines(raw, views.meeting_parts(spark, sf), "whole_lines")
    return land(describe_byte_lines(raw), "files"), raw


def parsed_meetings(spark, sf) -> meetings.Meetings:
    files, raw = meeting_bytes(spark, sf)
    return meetings.parse_files(files, raw)


@query
def meeting_files(spark, sf):
    return meeting_bytes(spark, sf)[0].select("file_name", "encoding", "delimiter", "error")


@query
def meeting_sessions(spark, sf):
    return parsed_meetings(spark, sf).sessions.drop("path", "source_file_hash", "encoding", "delimiter")


@query
def meeting_participants(spark, sf):
    return parsed_meetings(spark, sf).participants


@query
def meeting_activities(spark, sf):
    return parsed_meetings(spark, sf).activities.drop("raw_record")


@query
def meeting_rejects(spark, sf):
    return parsed_meetings(spark, sf).rejects.select("path", "source_row_number", "error_code")


@query
def meeting_fixed_offset(spark, sf):
    files, raw = meeting_bytes(spark, sf)
    return meetings.fixed_offset_files(files, raw, ["Name", "Email"])


def raw_loaded(spark, sf) -> loads.RawBatch:
    nothing = spark.createDataFrame([], "source_file_hash string, session_source_key string")
    return loads.raw_batch(parsed_meetings(spark, sf), nothing, loads.Highest(run_id=100))


@query
def raw_load(spark, sf):
    return raw_loaded(spark, sf).participants.select(
        "source_file_name", "source_row_number", "session_raw_id", "run_id", "participant_raw_id"
    )


@query
def raw_load_activities(spark, sf):
    return raw_loaded(spark, sf).activities.select(
        "source_file_name", "source_row_number", "session_raw_id", "run_id", "activity_raw_id"
    )


@query
def raw_load_sessions(spark, sf):
    return raw_loaded(spark, sf).sessions.select("source_file_name", "session_raw_id", "run_id", "meeting_title_raw", "meeting_duration_raw")


@query
def raw_load_errors(spark, sf):
    return raw_loaded(spark, sf).errors.select("run_id", "pipeline_name", "source_name", "source_row_number", "error_code")


@query
def file_hashes(spark, sf):
    """Pages as files of their lines: pages with the same content have the same hash, and no others."""
    raw, _ = page_files(spark, sf)
    files = describe_byte_lines(raw)
    first = files.groupBy("source_file_hash").agg(F.min("path").alias("first_path"))
    return files.join(first, "source_file_hash").select("path", "length", "last_line", "encoding", "first_path")


@query
def file_lines(spark, sf):
    """The lines of documents read as files."""
    raw, files = page_files(spark, sf)
    return decode_lines(raw, files).groupBy("path").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.max_by("line", "line_number").alias("last_text")
    )


def page_files(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Documents as files: the bytes between line feeds, and the facts of the files."""
    text = F.col("text")
    pieces = F.split(text, "\n", -1)
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("path"), F.octet_length(text).cast("bigint").alias("length"),
        F.posexplode(F.when(text.endswith("\n"), F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)).alias("at", "line"),
    )
    lines = rows.select("path", F.col("path").alias("file_name"), "length", (F.col("at") + 1).cast("bigint").alias("line_number"), F.col("line").cast("binary").alias("raw"))
    raw = land(whole_lines(lines.where("length > 0")), "whole_lines")
    return raw, land(describe_byte_lines(raw), "files")


@query
def records_over_lines(spark, sf):
    """Documents as quoted cells of a file per source: a record goes over as many lines as its text."""
    quoted = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('",end'))
    pieces = table(spark, sf, "documents").select(F.col("source").alias("path"), "doc_id", F.posexplode(F.split(quoted, "\n", -1)).alias("piece", "line"))
    # Lines of a document follow each other; a document has fewer than a million.
    ordered = pieces.withColumn("order", F.col("doc_id") * 1_000_000 + F.col("piece"))
    lines = views.number_within(ordered, ["path"], "order", "line_number", 1_000_000_000).select("path", "line_number", "line", F.lit(",").alias("delimiter"))
    cell = lambda k: F.get("cells", F.lit(k))
    return read_records(land(lines, "lines")).select("path", "row_number", cell(0).cast("bigint").alias("doc_id"), F.sha2(cell(1), 256).alias("text_sha256"), F.size("cells").alias("width"), "unclosed")


@query
def raw_load_runs(spark, sf):
    return audit.run_states(raw_loaded(spark, sf).run_events).select(
        "source_name", "run_id", "status", "rows_read", "rows_loaded", "rows_rejected"
    )


def employee_readings(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The employee files, their layouts and their records."""
    files, lines = views.employee_file_lines(spark, sf)
    return files, *profiles.read_layout(land(lines, "lines"))


@query
def file_profile(spark, sf):
    files, layout, records = employee_readings(spark, sf)
    return profiles.profile_records(layout, records, files).drop("path").withColumn("columns", F.array_join("columns", ","))


@query
def mixed_csv_rows(spark, sf):
    _, layout, records = employee_readings(spark, sf)
    cells = F.col("cells")
    return profiles.table_rows(records, profiles.find_headers(records, layout)).select(
        "path", "row_number", "fits", F.size(cells).alias("width"), cells[0].alias("first_cell"), cells[1].alias("second_cell")
    )


@query
def resolved_columns(spark, sf):
    _, layout, records = employee_readings(spark, sf)
    return profiles.resolve_columns(profiles.header_names(records, profiles.find_headers(records, layout)))


@query
def mixed_csv_table(spark, sf):
    """Cells of the employee files under the names of their columns."""
    files, layout, records = employee_readings(spark, sf)
    exports = tables.Dataset("EMPLOYEE_EXPORT", "employees", {field: names for field, names in profiles.COLUMN_ALIASES.items()}, ())
    described = files.withColumn("source_file_hash", F.sha2("path", 256))
    schema = tables.schemas(records, profiles.find_headers(records, layout), described, (exports,))
    named = tables.named_rows(records, schema).where("fits")
    return named.select("path", "row_number", F.explode("named").alias("column_name", "cell"))


def activity_tables(spark, sf) -> tables.Tables:
    files, lines = views.activity_file_lines(spark, sf)
    return tables.read_tables(files, land(lines, "lines"))


@query
def timesheet_people(spark, sf):
    """The employee master out of rendered timesheets of different layouts."""
    return master.employee_master([activity_tables(spark, sf).people])


@query
def timesheet_facts(spark, sf):
    """Work, absence and exam facts out of rendered files, as a store has taken them."""
    found = activity_tables(spark, sf).rows.withColumn("run_id", F.lit(1).cast("bigint"))
    parts = timesheets.activity_facts(found, views.dim_employee(spark, sf), views.dim_project(spark, sf))
    store = loads.Store(spark, storage_folder(spark), digits=1)
    number = store.begin()
    store.write_version("dim_employee", views.dim_employee(spark, sf), number)
    store.write_version("dim_project", views.dim_project(spark, sf), number)
    batch.add_facts(store, reduce(DataFrame.unionByName, parts.values()), number, "timesheets")
    store.commit(number)
    stored = store.rows("fact_employee_activity", schemas.TARGET["fact_employee_activity"])
    return _shown(stored, "activity_key", "training_key", "load_timestamp", "etl_run_id")


@query
def timesheet_rejects(spark, sf):
    return activity_tables(spark, sf).rejects.select("path", "source_row_number", "error_code", "error_message")


@query
def input_files(spark, sf):
    """Customers written as real files, one per nation: found, read line by line and by the plain reader."""
    folder = f"{storage_folder(spark)}/people"
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", F.col("c_nationkey").alias("nation"))
    rows.repartition("nation").write.partitionBy("nation").option("header", True).csv(folder)
    found = find_input_files(spark, folder).select("path", "file_name", "length")
    _, lines = read_files(spark, folder, "*.csv")
    counted = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n_lines"), F.max(F.when(F.col("line_number") == 1, F.col("line"))).alias("header"))
    nation = F.regexp_extract("path", "nation=([0-9]+)", 1).cast("int")
    return found.join(counted, "path").select(nation.alias("nation"), F.col("file_name").endswith(".csv").alias("is_csv"), "length", "n_lines", "header")


@query
def plain_table(spark, sf):
    """A plain delimited file, its types inferred."""
    path = f"{storage_folder(spark)}/orders.csv"
    loads.write_csv(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), path)
    found = read_table(spark, path)
    kinds = ",".join(kind for _, kind in found.dtypes)
    return found.select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("day").cast("string").alias("day"), F.lit(kinds).alias("kinds"))


@query
def unique_headers(spark, sf):
    """Roles of a dialogue as header cells; those of the assistant are blank."""
    turns = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("path"), (F.col("turn") + 1).alias("position"),
        F.when(F.col("role") == "assistant", " ").otherwise(F.col("role")).alias("raw"),
    )
    return profiles.name_columns(turns).select(F.col("path").alias("conv_id"), "position", "header")


@query
def file_inventory(spark, sf):
    """A plain file per customer with its orders as rows."""
    order_cells = F.array(
        F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderstatus")
    )
    name = F.concat(F.lit("Meeting"), F.col("o_custkey").cast("string"))
    orders = table(spark, sf, "orders")
    body = orders.select(name.alias("path"), (F.col("o_orderkey") + 2).alias("row_number"), order_cells.alias("cells"))
    paths = orders.select(name.alias("path")).distinct()
    head = paths.select("path", F.lit(1).cast("bigint").alias("row_number"), F.array(*[F.lit(c) for c in ("key", "price", "status")]).alias("cells"))
    files = paths.select("path", F.col("path").alias("file_name"), F.lit(None).cast("string").alias("error"))
    found = profiles.inventory(body.unionByName(head), files)
    return found.drop("path", "error").withColumns({c: F.to_json(c) for c in ("columns", "column_types", "first_rows")})
