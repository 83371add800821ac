"""One batch from files to facts: raw load, staging, rules, dimensions, facts, commit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall import schemas
from rollcall.operators import audit, dims, facts, known, loads, stage, upsert
from rollcall.operators.loads import Highest, Store
from rollcall.operators.ranking import number_by_hash
from rollcall.plans import constraints, quality, reports
from rollcall.sources import master
from rollcall.sources.files import FILE_COLUMNS, describe_files, describe_paths, empty_files, plain_name, require_files
from rollcall.sources.meetings import LABEL_WORDS, Meetings, parse_files
from rollcall.storage import job, land

RAW, STAGING, TARGET, CONTROL = schemas.SOURCES, schemas.STAGING, schemas.TARGET, schemas.CONTROL


MEETING_GLOB = "Meeting*.csv"


#: Paths that a load names one by one; beyond that the folder is read as a whole.
MOST_PATHS = 10_000


def load_folder(spark: SparkSession, directory: str | list[str], store: Store, people: list[DataFrame] | None = None) -> int:
    """Load the meeting exports of a folder.

    Files that are known by path, length and time are not read again, and others with a content that is loaded are
    not parsed again (``operators.known``). What is landed on the way goes when the batch is committed.
    """
    with job(spark):
        return _load_folder(spark, directory, store, people)


def _load_folder(spark: SparkSession, directory: str | list[str], store: Store, people: list[DataFrame] | None) -> int:
    require_files(spark, directory, MEETING_GLOB)
    listed = land(known.listing(spark, directory, MEETING_GLOB), "listing")
    same = land(known.unchanged_files(store, listed), "unchanged_files")
    changed = listed.join(same, "path", "left_anti")
    few = [row[0] for row in changed.select("location").limit(MOST_PATHS + 1).collect()]
    files, raw = _describe(spark, directory, few, same)
    loaded = known.loaded_meetings(store, files.where("source_file_hash IS NOT NULL")).select("source_file_hash").distinct()
    fresh = land(files.join(loaded, "source_file_hash", "left_anti").select(*files.columns), "fresh_files")
    again = files.join(loaded, "source_file_hash", "left_semi").select(*FILE_COLUMNS)
    unread = same.withColumn("file_name", F.substring_index("path", "/", -1)).select(
        "path", plain_name("file_name").alias("file_name"), "length", "source_file_hash", *(F.lit(None).cast("string").alias(c) for c in ("encoding", "delimiter", "error"))
    )
    meetings = parse_files(fresh, raw)
    whole = replace(meetings, files=meetings.files.unionByName(again).unionByName(unread))
    return load_meetings(whole, store, people, listed.join(files.select("path", "source_file_hash"), "path"))


def _describe(spark: SparkSession, directory: str | list[str], changed: list[str], same: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``describe_files`` of the files that have changed, and of empty ones. ``changed`` are their locations, if they are few."""
    if len(changed) > MOST_PATHS:
        files, raw = describe_files(spark, directory, MEETING_GLOB, LABEL_WORDS)
        return files.join(same, "path", "left_anti"), raw.join(same, "path", "left_anti")
    return describe_paths(spark, changed, empty_files(spark, directory, MEETING_GLOB), MEETING_GLOB, LABEL_WORDS)


def load_meetings(meetings: Meetings, store: Store, people: list[DataFrame] | None = None, seen: DataFrame | None = None) -> int:
    """Load parsed meetings as one batch and give its number.

    ``people`` are further lists of names and emails, such as those of timesheets, in the form of
    ``master.people_list``; ``seen`` are the files that were read, as ``known_file`` has them. Each step reads what the
    step before has written.
    """
    batch = store.begin()
    _load_raw(meetings, store, batch)
    _stage_and_check(store, batch)
    _load_dimensions(store, batch, people or [])
    _load_facts(store, batch)
    _remember(store, batch, seen)
    commit(store, batch)
    return batch


def _remember(store: Store, batch: int, seen: DataFrame | None) -> None:
    """The meetings of the batch, and of the files seen those whose content is loaded by now."""
    own = store.rows("training_session_raw", RAW["training_session_raw"], batch).select("source_file_hash", "session_source_key")
    known.remember(store, batch, "known_hash", "source_file_hash", own)
    known.remember(store, batch, "known_session", "session_source_key", own)
    if seen is not None:
        seen = land(seen, "seen_files")
        hashes = known.loaded_meetings(store, seen).unionByName(own).select("source_file_hash").distinct()
        known.remember(store, batch, "known_file", "path", land(seen.join(hashes, "source_file_hash", "left_semi"), "known_files"))


def commit(store: Store, batch: int) -> None:
    """Commit a batch with the highest keys that its writes have observed."""
    store.commit(batch)


def _with_clock(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, F.current_timestamp())


def _load_raw(meetings: Meetings, store: Store, batch: int) -> None:
    loaded = known.loaded_meetings(store, meetings.sessions, meetings.sessions)
    raw = loads.raw_batch(meetings, loaded, Highest(*(store.highest(key) for key in ("run_id", "session_raw_id", "participant_raw_id", "activity_raw_id"))))
    store.write_batch("training_session_raw", _with_clock(raw.sessions, "process_timestamp"), batch, highest=["session_raw_id"])
    store.write_batch("training_participant_raw", _with_clock(raw.participants, "process_timestamp"), batch, highest=["participant_raw_id"])
    store.write_batch("training_activity_raw", _with_clock(raw.activities, "process_timestamp"), batch, highest=["activity_raw_id"])
    store.write_batch("etl_error_log_ingest", _with_clock(raw.errors, "created_at"), batch)
    store.write_batch("etl_run_event", raw.run_events, batch, highest=["run_id"])


def _raw(store: Store, batch: int, table: str) -> DataFrame:
    return store.rows(table, RAW[table], batch)


def _staged(store: Store, batch: int, table: str) -> DataFrame:
    return store.rows(table, STAGING[table], batch)


def _stage_and_check(store: Store, batch: int) -> None:
    session_raw, participant_raw = _raw(store, batch, "training_session_raw"), _raw(store, batch, "training_participant_raw")
    activity_raw = _raw(store, batch, "training_activity_raw")
    store.write_batch("stg_training_session", stage.stage_sessions(session_raw), batch)
    store.write_batch("stg_training_participant", stage.stage_participants(participant_raw), batch)
    store.write_batch("stg_training_activity", stage.stage_activities(activity_raw), batch)
    sessions, participants, activities = [
        _staged(store, batch, f"stg_training_{name}") for name in ("session", "participant", "activity")
    ]
    rejects = quality.reject_log(
        quality.session_rejects(sessions, session_raw), quality.participant_rejects(participants, participant_raw),
        quality.activity_rejects(activities, activity_raw),
    )
    # Rejects of ingestion are a table of their own, so a second validation clears only its own.
    store.write_batch("etl_error_log", _with_clock(rejects, "created_at"), batch)
    results = quality.quality_results(sessions, participants, activities, participant_raw)
    store.write_batch("data_quality_result", _with_clock(results, "checked_at"), batch)


def _load_dimensions(store: Store, batch: int, people: list[DataFrame]) -> None:
    spark = store.spark
    attended = master.people_list(
        _raw(store, batch, "training_participant_raw"), "participant_name_raw", "email_raw", "participant_raw_id", 1
    )
    employees = master.employee_master([attended, *people]).withColumns({
        "dataset_name": F.lit("EMPLOYEE_MASTER"), "source_file_name": F.lit("employee_master"),
        "process_timestamp": F.current_timestamp(),
    })
    store.write_batch("stg_employee", stage.stage_employees(employees), batch)
    merge_employees(store, batch, _staged(store, batch, "stg_employee"))
    merge_trainings(store, batch, _staged(store, batch, "stg_training_session"))


def _merge(store: Store, batch: int, table: str, key: str, surrogate: str, incoming: DataFrame, merged: Callable[[DataFrame, int], DataFrame]) -> None:
    """Write those buckets of a dimension that the keys of ``incoming`` fall into; the rest of it is neither read nor written."""
    buckets = store.touched(incoming, key)
    if buckets:
        rows = merged(store.version(table, TARGET[table], buckets=buckets), store.highest(surrogate))
        store.write_buckets(table, rows, batch, key, buckets, highest=[surrogate])


def merge_employees(store: Store, batch: int, staged: DataFrame) -> None:
    """K6. The unknown member, which has a key of its own, comes with the first employees."""
    unknown = dims.unknown_employee(store.spark)
    first = store.version("dim_employee", TARGET["dim_employee"], buckets=store.touched(unknown, "employee_id")).isEmpty()
    incoming = staged.where("validation_status = 'VALID'").select("employee_id")

    def merged(before: DataFrame, highest: int) -> DataFrame:
        return upsert.upsert_employees(before.unionByName(unknown.select(*before.columns)) if first else before, staged, highest=highest)

    _merge(store, batch, "dim_employee", "employee_id", "employee_key", incoming.unionByName(unknown.select("employee_id")) if first else incoming, merged)


def merge_trainings(store: Store, batch: int, staged: DataFrame) -> None:
    """K7."""
    incoming = staged.where("validation_status = 'VALID'").select(F.col("session_source_key").alias("training_source_key"))
    _merge(
        store, batch, "dim_training", "training_source_key", "training_key", incoming,
        lambda before, highest: upsert.upsert_trainings(before, staged, highest=highest),
    )


def merge_projects(store: Store, batch: int, names: DataFrame) -> None:
    """D5."""
    names = land(names.select("project_name").distinct(), "project_names")
    _merge(store, batch, "dim_project", "project_name", "project_key", names, lambda before, highest: upsert.upsert_projects(before, names, highest))


def _load_facts(store: Store, batch: int) -> None:
    rows = facts.training_facts(
        _staged(store, batch, "stg_training_participant"), _raw(store, batch, "training_participant_raw"),
        _staged(store, batch, "stg_training_session"), store.version("dim_training", TARGET["dim_training"], batch),
        store.version("dim_employee", TARGET["dim_employee"], batch),
    )
    add_facts(store, rows, batch, "training")


def add_facts(store: Store, rows: DataFrame, batch: int, part: str) -> None:
    """Check fact rows against the stored history, number them and write them as a part of the facts of an open batch.

    A fact that its source has given before, in an earlier batch or part, is rejected, and so is one that points at a day or
    a member that does not exist; both leave a quality row and an error row (V7, V8).
    """
    schema = TARGET["fact_employee_activity"]
    checked = constraints.checked_facts(store, land(rows, "fact_rows"), batch, part)
    highest = max(store.highest("activity_key"), store.noted(batch).get("activity_key", 0))
    numbered = number_by_hash(
        checked.accepted, ["source_system", "source_record_id", "activity_type_key"], "activity_key", highest, costly=True
    )
    timed = _with_clock(numbered, "load_timestamp")
    store.write_batch("fact_employee_activity", timed.select(*schema.names), batch, part, highest=["activity_key"])
    written = store.rows("fact_employee_activity", schema, batch, part=part)
    store.write_batch("fact_digest", constraints.digests(written, store.digits), batch, part, by="bucket")
    months = reports.monthly_partials(written, dims.calendar(store.spark), dims.activity_types(store.spark))
    store.write_batch("fact_month", months.select(*TARGET["fact_month"].names), batch, part)
    results = quality.fact_constraints(written).unionByName(checked.results)
    store.write_batch("data_quality_result", _with_clock(results, "checked_at"), batch, f"facts_{part}")
    store.write_batch("etl_error_log", _with_clock(quality.fact_rejects(written).unionByName(checked.errors), "created_at"), batch, f"facts_{part}")


def monthly_rank(store: Store) -> DataFrame:
    """R2 out of the sums that each batch has left."""
    partials = store.rows("fact_month", TARGET["fact_month"])
    return reports.monthly_rank_from_partials(reports.fold_partials(partials), store.version("dim_employee", TARGET["dim_employee"]))


def run_table(store: Store) -> DataFrame:
    """The run table as it is after the last batch."""
    return audit.run_states(store.rows("etl_run_event", CONTROL["etl_run_event"]))


def error_log(store: Store) -> DataFrame:
    """All rejected records, of ingestion and of validation."""
    return store.rows("etl_error_log_ingest", CONTROL["etl_error_log"]).unionByName(
        store.rows("etl_error_log", CONTROL["etl_error_log"])
    )
