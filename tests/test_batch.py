"""The whole batch: files to facts and reports, run twice, with bad files among them."""

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.operators import dims
from rollcall.operators.loads import Store
from rollcall.plans import batch, reports
from rollcall.streaming.arrivals import load_arrivals
from tests.test_meetings import export


def table(store, name, group):
    return store.rows(name, getattr(schemas, group)[name])


def snapshot(store):
    fact = table(store, "fact_employee_activity", "TARGET").drop("load_timestamp")
    return sorted(map(str, fact.collect())), sorted(map(str, store.version("dim_employee", schemas.TARGET["dim_employee"]).drop("process_timestamp").collect()))


def test_batch_twice(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    people = [
        ["Ann", "3/4/26, 9:05:00 AM", "3/4/26, 11:05:00 AM", "2h 0m 0s", " Ann@X.com", "1", ""],
        ["Bob", "3/5/26, 9:05:00 AM", "", "45m", "bob@x.com", "2", ""],
        ["Cat", "", "", "10m", "", "3", ""],
        ["Dan", "3/4/26, 9:05:00 AM", "", " ", "dan@x.com", "4", ""],
        ["", "", "", "1h", "", "", ""],
    ]
    first, _ = export("Alpha", people)
    (inbox / "Meeting1.csv").write_bytes(first)
    (inbox / "Meeting2.csv").write_bytes(export("Beta")[0])
    (inbox / "Meeting [3].csv").write_bytes(b"")
    store = Store(spark, str(tmp_path / "store"), digits=1)
    assert batch.load_folder(spark, str(inbox), store) == 1

    runs = {r.source_name: r for r in batch.run_table(store).collect()}
    assert (runs["Meeting1.csv"].status, runs["Meeting1.csv"].rows_read, runs["Meeting1.csv"].rows_rejected) == ("SUCCESS", 7, 1)
    assert (runs["Meeting2.csv"].status, runs["Meeting2.csv"].rows_loaded) == ("SUCCESS", 4)
    assert (runs["Meeting [3].csv"].status, runs["Meeting [3].csv"].error_message) == ("FAILED", "File is empty: Meeting [3].csv")
    assert {r.run_id for r in runs.values()} == {1, 2, 3}

    errors = {(e.error_code, e.source_name, e.source_row_number) for e in batch.error_log(store).collect()}
    assert errors == {("EMPTY_FILE", "Meeting [3].csv", None), ("NO_IDENTITY", "Meeting1.csv", 15), ("INVALID_PARTICIPANT", "Meeting1.csv", 14)}

    facts = table(store, "fact_employee_activity", "TARGET")
    employees = store.version("dim_employee", schemas.TARGET["dim_employee"])
    assert {e.employee_id for e in employees.collect()} == {"UNKNOWN", "ann@x.com", "ann@example.com", "bob@x.com", "dan@x.com"}
    shown = facts.join(employees, "employee_key").select("employee_id", "date_key", F.col("hours").cast("string")).collect()
    assert sorted(map(tuple, shown)) == [
        ("UNKNOWN", 20260304, "0.17"), ("ann@example.com", 20260304, "1.25"), ("ann@x.com", 20260304, "2.00"), ("bob@x.com", 20260305, "0.75"),
    ]
    assert sorted(r.activity_key for r in facts.collect()) == [1, 2, 3, 4]

    # A copy under another name, and the same meeting with other content.
    before = snapshot(store)
    (inbox / "Meeting4.csv").write_bytes(first)
    (inbox / "Meeting5.csv").write_bytes(first.replace(b"45m", b"46m"))
    assert batch.load_folder(spark, str(inbox), store) == 2
    assert snapshot(store) == before
    runs = batch.run_table(store).where("run_id > 3").collect()
    assert {(r.source_name, r.status, r.rows_read) for r in runs} == {
        ("Meeting1.csv", "SUCCESS", 0), ("Meeting2.csv", "SUCCESS", 0), ("Meeting [3].csv", "FAILED", 0),
        ("Meeting4.csv", "SUCCESS", 0), ("Meeting5.csv", "FAILED", 0),
    }

    # With nothing new a run still leaves its trace, and nothing else.
    assert batch.load_folder(spark, [str(inbox / "Meeting1.csv"), str(inbox / "Meeting2.csv")], store) == 3
    assert snapshot(store) == before
    assert {(r.status, r.rows_read) for r in batch.run_table(store).where("run_id > 8").collect()} == {("SUCCESS", 0)}

    quality = {(r.rule_name, r.result_status) for r in table(store, "data_quality_result", "CONTROL").where("run_id <= 3").collect()}
    assert ("TRAINING_PARTICIPANT_VALIDATION", "FAILED") in quality and ("REPORTED_VS_PARSED_PARTICIPANTS", "WARNING") in quality

    report = reports.employees_without_activity(employees, facts).collect()
    assert [r.employee_id for r in report] == ["dan@x.com"]
    counts = reports.source_target_counts(
        table(store, "training_session_raw", "SOURCES"), table(store, "stg_training_participant", "STAGING"), facts,
        dims.activity_types(spark), same_grain=True,
    ).first()
    assert (counts.source_count, counts.target_count, counts.status) == (4, 4, "PASS")


def test_uncommitted_batch_is_not_read_and_is_replaced(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["dim_project"]
    rows = spark.createDataFrame([(1, "a")], schema)
    store.write_batch("t", rows, 1)
    assert store.rows("t", schema).isEmpty()
    store.write_batch("t", spark.createDataFrame([], schema), 1)
    store.commit(1)
    assert store.rows("t", schema).isEmpty() and store.last_batch() == 1
    store.write_batch("t", rows, 2)
    store.write_version("v", rows, 2)
    assert store.rows("t", schema).isEmpty() and store.version("v", schema).isEmpty()
    store.commit(2)
    assert store.rows("t", schema).count() == 1 and store.version("v", schema).count() == 1


def test_arrivals_load_only_what_is_new(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    store = Store(spark, str(tmp_path / "store"), digits=1)
    for number, title in enumerate(["Alpha", "Beta"], 1):
        (inbox / f"Meeting{number}.csv").write_bytes(export(title)[0])
        load_arrivals(spark, str(inbox), store, str(tmp_path / "checkpoint")).awaitTermination()
        assert table(store, "training_session_raw", "SOURCES").count() == number
    assert store.last_batch() == 2
    assert batch.run_table(store).count() == 2


def test_a_batch_without_dimensions_keeps_them(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    dimension, fact = schemas.TARGET["dim_project"], schemas.TARGET["dim_project"]
    rows = spark.createDataFrame([(1, "a")], dimension)
    store.write_version("dim", rows, 1)
    store.commit(1, {"project_key": 1})
    store.write_batch("facts", spark.createDataFrame([(7, "f")], fact), 2, "timesheet")
    store.commit(2, {"fact_key": 7})
    assert [tuple(r) for r in store.version("dim", dimension).collect()] == [(1, "a")]
    assert (store.highest("project_key"), store.highest("fact_key"), store.highest("other")) == (1, 7, 0)
    assert Store(spark, str(tmp_path)).version("dim", dimension).count() == 1


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["dim_project"]
    rows = spark.createDataFrame([(1, "a")], schema)
    store.write_batch("t", rows, 1, "x")
    store.write_batch("t", spark.createDataFrame([(2, "b")], schema), 1, "y")
    store.commit(1)
    for write in (lambda: store.write_batch("t", rows, 1, "x"), lambda: store.write_version("v", rows, 1), lambda: store.commit(1)):
        with pytest.raises(ValueError, match="committed"):
            write()
    assert sorted(r[0] for r in store.rows("t", schema).collect()) == [1, 2]


def test_facts_in_parts_of_one_batch_have_keys_of_their_own(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["fact_employee_activity"]
    fields = [f for f in schema.fields if f.name not in ("activity_key", "load_timestamp")]

    def some(system, n):
        values = {"source_system": system, "activity_type_key": 1, "employee_key": 0}
        return spark.createDataFrame([tuple({**values, "source_record_id": str(k)}.get(f.name) for f in fields) for k in range(n)], schema.__class__(fields))

    batch.add_facts(store, some("A", 3), 1, "a")
    batch.add_facts(store, some("B", 4), 1, "b")
    batch.add_facts(store, some("A", 2), 1, "a")
    batch.commit(store, 1)
    keys = [r.activity_key for r in store.rows("fact_employee_activity", schema).collect()]
    assert len(keys) == len(set(keys)) == 6
    with pytest.raises(ValueError, match="committed"):
        batch.add_facts(store, some("C", 1), 1, "c")
    batch.add_facts(store, some("C", 1), 2, "c")
    batch.commit(store, 2)
    assert store.rows("fact_employee_activity", schema).count() == 7 and store.highest("activity_key") > max(keys)


def test_a_version_that_is_gone_is_an_error(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["dim_project"]
    store.write_version("v", spark.createDataFrame([(1, "a")], schema), 1)
    store.commit(1)
    (tmp_path / "v").rename(tmp_path / "elsewhere")
    with pytest.raises(AnalysisException):
        store.version("v", schema).collect()


def test_an_empty_file_that_arrives_is_reported(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "Meeting 1+2.csv").write_bytes(b"")
    store = Store(spark, str(tmp_path / "store"), digits=1)
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "rollcall"
    landed = set(shared.glob("*"))
    load = lambda: load_arrivals(spark, str(inbox), store, str(tmp_path / "checkpoint")).awaitTermination()
    load()
    (inbox / "Meeting3.csv").write_bytes(export("Alpha")[0])
    (inbox / "Meeting4.csv").write_bytes(b"")
    load()
    runs = {(r.source_name, r.status, r.error_message) for r in batch.run_table(store).collect()}
    assert runs == {
        ("Meeting 1+2.csv", "FAILED", "File is empty: Meeting 1+2.csv"), ("Meeting3.csv", "SUCCESS", None), ("Meeting4.csv", "FAILED", "File is empty: Meeting4.csv"),
    }
    assert set(shared.glob("*")) == landed  # what the loads have landed is gone


def buckets_of(df):
    return {part.removeprefix("bucket=") for name in df.inputFiles() for part in name.split("/") if part.startswith("bucket=")}


def test_a_load_writes_and_reads_only_the_buckets_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["dim_project"]
    names = spark.createDataFrame([(f"project {k}",) for k in range(300)], "project_name string")
    first = store.begin()
    batch.merge_projects(store, first, names)
    store.commit(first)
    before = {p: (p.stat().st_mtime_ns, p.read_bytes()) for p in (tmp_path / "dim_project").rglob("*.parquet")}
    second = store.begin()
    fresh = spark.createDataFrame([("project 7",), ("project 1000",)], "project_name string")
    batch.merge_projects(store, second, fresh)
    assert store.version("dim_project", schema).count() == 300  # an open batch is not read
    Store(spark, str(tmp_path)).commit(second)  # any store on the folder can commit it
    store = Store(spark, str(tmp_path))
    rows = {r.project_name: r.project_key for r in store.version("dim_project", schema).collect()}
    assert len(rows) == 301 and rows["project 1000"] == 301 == store.highest("project_key") and len(set(rows.values())) == 301
    touched = set(store.touched(fresh, "project_name"))
    assert buckets_of(spark.read.parquet(str(tmp_path / "dim_project" / f"version={second}"))) == touched and len(touched) == 2
    assert all((p.stat().st_mtime_ns, p.read_bytes()) == was for p, was in before.items())
    found = store.version("dim_project", schema, buckets=sorted(touched))
    assert buckets_of(found) == touched and {r.project_name for r in found.collect()} >= {"project 7", "project 1000"}


def test_notes_of_a_try_that_died_are_dropped(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    schema = schemas.TARGET["dim_project"]
    rows = spark.createDataFrame([(1, "a")], schema)
    store.write_version("v", rows, store.begin())
    number = store.begin()
    store.write_batch("t", rows, number, highest=["project_key"])
    store.commit(number)
    assert store.version("v", schema).isEmpty() and store.highest("project_key") == 1 and number == 1


def test_unchanged_files_are_not_read_again(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for k, title in enumerate(["Alpha", "Beta", "Gamma"]):
        (inbox / f"Meeting{k}.csv").write_bytes(export(title)[0])
    store = Store(spark, str(tmp_path / "store"), digits=1)
    batch.load_folder(spark, str(inbox), store)
    read = []
    described = batch.describe_paths
    monkeypatch.setattr(batch, "describe_paths", lambda spark, paths, *more: read.append(paths) or described(spark, paths, *more))
    (inbox / "Meeting9.csv").write_bytes(export("Delta")[0])
    (inbox / "Meeting1.csv").write_bytes(export("Epsilon")[0])
    batch.load_folder(spark, str(inbox), store)
    assert [sorted(p.rsplit("/", 1)[1] for p in paths) for paths in read] == [["Meeting1.csv", "Meeting9.csv"]]
    runs = {(r.source_name, r.rows_read) for r in batch.run_table(store).where("run_id > 3").collect()}
    assert runs == {("Meeting0.csv", 0), ("Meeting2.csv", 0), ("Meeting1.csv", 4), ("Meeting9.csv", 4)}
    monkeypatch.setattr(batch, "MOST_PATHS", 0)
    (inbox / "Meeting5.csv").write_bytes(export("Zeta")[0])
    batch.load_folder(spark, str(inbox), store)
    assert table(store, "training_session_raw", "SOURCES").count() == 6 and len(read) == 1


def facts_of(spark, rows):
    """Fact rows from (source_record_id, run_id, date_key, employee_key, hours)."""
    schema = schemas.TARGET["fact_employee_activity"]
    names = [f for f in schema.fields if f.name not in ("activity_key", "load_timestamp")]
    values = lambda r: {"source_system": "S", "source_record_id": r[0], "activity_type_key": 1, "etl_run_id": r[1], "date_key": r[2], "employee_key": r[3], "hours": Decimal(r[4])}
    return spark.createDataFrame([tuple(values(r).get(f.name) for f in names) for r in rows], schema.__class__(names))


def test_facts_are_checked_against_all_that_is_stored(spark, tmp_path):
    store = Store(spark, str(tmp_path), digits=1)
    first = store.begin()
    batch.add_facts(store, facts_of(spark, [("a", 1, 20250101, 0, 1), ("b", 1, 20250101, 0, 2), ("b", 1, 20250101, 0, 2), ("old", 1, 19990101, 0, 2)]), first, "x")
    batch.add_facts(store, facts_of(spark, [("b", 2, 20250101, 0, 3), ("c", 2, 20250102, 0, 3)]), first, "y")
    batch.commit(store, first)
    store = Store(spark, str(tmp_path))
    assert store.digits == 1  # as the first commit has fixed it
    second = store.begin()
    batch.add_facts(store, facts_of(spark, [("a", 3, 20250101, 0, 9), ("d", 3, 20250102, 77, 3), ("e", 3, 20250102, None, 3)]), second, "x")
    batch.commit(store, second)
    facts = table(store, "fact_employee_activity", "TARGET").collect()
    assert sorted((f.source_record_id, f.etl_run_id) for f in facts) == [("a", 1), ("b", 1), ("c", 2), ("e", 3)]
    assert sorted(f.activity_key for f in facts) == [1, 2, 3, 4] and store.highest("activity_key") == 4
    failed = {(r.run_id, r.rule_name, r.checked_rows, r.failed_rows) for r in table(store, "data_quality_result", "CONTROL").where("failed_rows > 0").collect()}
    unique = "UNIQUE_SOURCE_SYSTEM_SOURCE_RECORD_ID_ACTIVITY_TYPE_KEY"
    assert failed == {
        (1, unique, 4, 1), (1, "REFERENCE_DATE_KEY", 4, 1), (2, unique, 2, 1), (3, unique, 3, 1), (3, "REFERENCE_EMPLOYEE_KEY", 3, 1), (3, "NOT_NULL_EMPLOYEE_KEY", 1, 1),
    }
    errors = {(e.run_id, e.error_code, e.raw_record) for e in table(store, "etl_error_log", "CONTROL").collect()}
    assert errors == {
        (1, unique, "b"), (1, "REFERENCE_DATE_KEY", "old"), (2, unique, "b"), (3, unique, "a"), (3, "REFERENCE_EMPLOYEE_KEY", "d"), (3, "NOT_NULL_EMPLOYEE_KEY", "e"),
    }
    months = batch.monthly_rank(store).collect()
    assert [(m.employee_id, m.month_number, str(m.total_hours), m.activity_count) for m in months] == [(None, 1, "9.00", 4)]
