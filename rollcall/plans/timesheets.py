"""Timesheets and exam schedules from files to facts (S17, U-CAT, D2-D5): one batch of its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall import schemas
from rollcall.operators import audit, facts, stage, upsert
from rollcall.operators.loads import Store
from rollcall.operators.ranking import number_by_hash
from rollcall.plans import batch
from rollcall.sources import master, tables
from rollcall.sources.files import decode_lines, describe_files
from rollcall.storage import job, land

PIPELINE = "TIMESHEETS"
#: Part of the facts and dataset it comes from.
PARTS = (("work", tables.WORK), ("absence", tables.ABSENCE), ("exam", tables.EXAM))


def activity_facts(rows: DataFrame, dim_employee: DataFrame, dim_project: DataFrame) -> dict[str, DataFrame]:
    """The fact rows of each part out of typed rows with a ``run_id``."""
    own = {part: tables.activity_rows(rows, dataset) for part, dataset in PARTS}
    return {
        "work": facts.work_facts(own["work"], dim_employee, dim_project),
        "absence": facts.absence_facts(own["absence"], dim_employee),
        "exam": facts.exam_facts(own["exam"], dim_employee),
    }


def load_timesheets(spark: SparkSession, directory: str | list[str], store: Store) -> int:
    """Load all timesheets and exam schedules of a folder as one batch and give its number.

    A file whose content is loaded already adds nothing; of new files with the same content the first by path counts.
    A file that cannot be read, or lacks a column, fails and the others go on. Employees and projects that the
    files name are added to the dimensions before the facts look for them.
    """
    with job(spark):
        files, raw = describe_files(spark, directory, "*.csv")
        own = files.where(tables.dataset_of("file_name").isNotNull())
        loaded = store.rows("activity_file", schemas.SOURCES["activity_file"]).select("source_file_hash")
        fresh = land(upsert.new_files(own, loaded).select(*own.columns), "fresh_files")
        return load_tables(tables.read_tables(fresh, decode_lines(raw, fresh)), own, fresh, store)


def load_tables(found: tables.Tables, files: DataFrame, fresh: DataFrame, store: Store) -> int:
    """Load tables that have been read. ``files`` are all files looked at, ``fresh`` those that were new."""
    number = store.begin()
    runs = land(number_by_hash(files.select("path", "file_name"), ["path"], "run_id", store.highest("run_id"), costly=True), "runs")
    rows = land(found.rows.join(runs.select("path", "run_id"), "path"), "activity_rows")
    rejects = found.rejects.join(runs, "path")
    failed = rejects.where("source_row_number IS NULL").select("path", F.col("error_message").alias("failure"))

    read = fresh.join(failed, "path", "left_anti").join(runs.select("path", "run_id"), "path")
    store.write_batch("activity_file", read.select("path", "file_name", "length", "source_file_hash", "run_id"), number)
    errors = audit.error_rows(
        rejects, pipeline=PIPELINE, source="file_name", code=F.col("error_code"), message=F.col("error_message"), row_number="source_row_number", raw_record="raw_record"
    )
    store.write_batch("etl_error_log_ingest", errors.withColumn("created_at", F.current_timestamp()), number, "timesheets")
    store.write_batch("etl_run_event", run_events(runs, rows, rejects, failed), number, "timesheets", highest=["run_id"])

    employees = master.employee_master([found.people]).withColumns({
        "dataset_name": F.lit("EMPLOYEE_MASTER"), "source_file_name": F.lit("employee_master"), "process_timestamp": F.current_timestamp(),
    })
    batch.merge_employees(store, number, stage.stage_employees(employees))
    batch.merge_projects(store, number, rows.where("project_name IS NOT NULL").select("project_name"))
    target = schemas.TARGET
    parts = activity_facts(rows, store.version("dim_employee", target["dim_employee"], number), store.version("dim_project", target["dim_project"], number))
    batch.add_facts(store, reduce(DataFrame.unionByName, parts.values()), number, "timesheets")
    store.commit(number)
    return number


def run_events(runs: DataFrame, rows: DataFrame, rejects: DataFrame, failed: DataFrame) -> DataFrame:
    """A run per file: a STARTED event and a SUCCESS with its counts, or FAILED with the reason."""
    opened = runs.select("path", "run_id", F.lit(PIPELINE).alias("pipeline_name"), F.col("file_name").alias("source_name"))
    loaded = rows.groupBy("path").agg(F.count(F.lit(1)).alias("loaded"))
    rejected = rejects.where("source_row_number IS NOT NULL").groupBy("path").agg(F.count(F.lit(1)).alias("rejected"))
    closed = opened.join(failed, "path", "left").join(loaded, "path", "left").join(rejected, "path", "left")
    loaded_rows, rejected_rows = F.coalesce("loaded", F.lit(0)), F.coalesce("rejected", F.lit(0))
    succeeded = audit.finish_success(closed.where("failure IS NULL"), loaded_rows + rejected_rows, loaded_rows, rejected_rows)
    return audit.start_runs(opened).unionByName(succeeded).unionByName(audit.finish_failed(closed.where("failure IS NOT NULL"), F.col("failure")))
