"""Rules, upserts, keys, ranking, audit and facts on small tables."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from rollcall import schemas
from rollcall.operators import audit, dims, facts, loads, ranking, rules, stage, upsert
from rollcall.operators.ranking import counts_before, dense_rank_desc, number_by_hash
from rollcall.plans import quality, reports
from rollcall.sources import files, master


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_first_broken_rule_gives_the_message(spark):
    raw = spark.createDataFrame(
        [(1, 1, "k", None, "x", "bad", "bad", "1h", None), (2, 1, "k", " T ", " 12 ", "bad", "bad", "", "2m"),
         (3, 1, "k", "T", "12", "6/24/25, 1:00 PM", "", "1h", ""), (4, 1, "k", "T", "1.5", "6/24/25, 1:00 PM", "6/24/25, 2:00 PM", "x", "")],
        "session_raw_id bigint, run_id bigint, session_source_key string, meeting_title_raw string, attended_participants_raw string, "
        "start_time_raw string, end_time_raw string, meeting_duration_raw string, average_attendance_time_raw string",
    )
    staged = stage.stage_sessions(raw)
    assert rows(staged, "session_raw_id", "validation_status", "validation_message", "reported_participant_count") == [
        (1, "INVALID", stage.TITLE_MISSING, None), (2, "INVALID", stage.START_INVALID, 12),
        (3, "INVALID", stage.END_INVALID, 12), (4, "VALID", None, None),
    ]
    assert staged.columns == schemas.STAGING["stg_training_session"].names[:9] + ["validation_message", "validation_status"]


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_dense_rank_equals_the_window(spark, width):
    generator = random.Random(width)
    data = [(generator.randint(1, 3), f"e{i}", generator.choice([0, 8, generator.randint(0, 4000)]) / 4, 1 + i % 3) for i in range(800)]
    frame = spark.createDataFrame(data, "m int, e string, h double, n int").withColumn("h", F.col("h").cast("decimal(20,2)"))
    got = dense_rank_desc(frame, ["m"], "h", "r", weight="n", bucket_width=width)
    want = frame.withColumn("r", F.dense_rank().over(Window.partitionBy("m").orderBy(F.desc("h"))))
    assert rows(got, "m", "e", "h", "r") == rows(want, "m", "e", "h", "r")


def test_ranking_plan_shares_the_facts(spark):
    """The ranked branch reuses the aggregated facts, so the facts are scanned once."""
    fact = spark.range(1000).select(
        (F.col("id") % 50).alias("employee_key"), F.lit(20240101).alias("date_key"), F.lit(1).alias("activity_type_key"),
        (F.col("id") % 7).cast("decimal(5,2)").alias("hours"),
    )
    employees = spark.range(40).select(F.col("id").alias("employee_key"), F.col("id").cast("string").alias("employee_id"), F.lit("n").alias("employee_name"))
    report = reports.monthly_activity_rank(fact, dims.calendar(spark), dims.activity_types(spark), employees)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert report.where("employee_id is null").count() == 1


def test_numbers_are_dense_and_stable(spark):
    frame = spark.range(5000).repartition(7).select(F.col("id").cast("string").alias("k"))
    first = dict(rows(number_by_hash(frame, ["k"], "n", start=10), "k", "n"))
    assert sorted(first.values()) == list(range(11, 5011))
    assert sorted(first, key=first.get) == sorted(first, key=lambda k: hashlib.sha256(k.encode()).hexdigest())
    assert first == dict(rows(number_by_hash(frame.repartition(3), ["k"], "n", start=10), "k", "n"))


PROJECTS = "project_key bigint, project_name string, note string"


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "old"), (5, "b", "old")], PROJECTS)
    source = spark.createDataFrame([("b", None), ("c", "new")], "project_name string, note string")
    merged = upsert.upsert(target, source, "project_name", update=["note"], surrogate="project_key")
    assert rows(merged, "project_key", "project_name", "note") == [(1, "a", "old"), (5, "b", None), (6, "c", "new")]
    again = upsert.upsert(merged, source, "project_name", update=["note"], surrogate="project_key")
    assert rows(again, "project_key", "project_name", "note") == rows(merged, "project_key", "project_name", "note")


def test_upsert_into_an_empty_target(spark):
    target = spark.createDataFrame([], PROJECTS)
    source = spark.createDataFrame([("b", "x")], "project_name string, note string")
    assert rows(upsert.upsert(target, source, "project_name", update=["note"], surrogate="project_key"), "project_key", "note") == [(1, "x")]


def test_duplicate_source_keys_fail_or_take_the_latest(spark):
    target = spark.createDataFrame([(1, "a", "old")], PROJECTS)
    source = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "project_name string, note string, at int")
    with pytest.raises(PySparkException, match="duplicate key in upsert source"):
        upsert.upsert(target, source, "project_name", update=["note"]).collect()
    assert rows(upsert.upsert(target, source, "project_name", update=["note"], latest_by="at"), "note") == [("y",)]


def test_insert_only_columns_stay(spark):
    empty = spark.createDataFrame([], schemas.TARGET["dim_training"])
    session = [(7, "k", "First", 3, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 1), "VALID")]
    kind = "session_raw_id bigint, session_source_key string, meeting_title string, reported_participant_count bigint, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, validation_status string"
    first = upsert.upsert_trainings(empty, spark.createDataFrame(session, kind))
    changed = [(9, "k", "Second", 4, *session[0][4:])]
    second = upsert.upsert_trainings(first, spark.createDataFrame(changed, kind))
    assert rows(second, "training_key", "training_name", "reported_participant_count", "source_system", "source_record_id") == [
        (1, "Second", 4, "MEETING_ATTENDANCE", "7")
    ]


def test_quality_rows_and_reported_counts(spark):
    sessions = spark.createDataFrame([(1, 1, 2), (1, 2, None), (2, 3, 1)], "run_id bigint, session_raw_id bigint, reported_participant_count bigint")
    people = spark.createDataFrame([(1,), (1,), (2,)], "session_raw_id bigint")
    counted = quality.reported_counts(sessions, people)
    assert rows(counted, "run_id", "checked_rows", "failed_rows") == [(1, 2, 0), (2, 1, 1)]
    result = rules.quality_rows(counted, "R", "T", None, on_failure="warning", details="d")
    assert rows(result, "run_id", "result_status") == [(1, "PASSED"), (2, "WARNING")]


def test_constraints(spark):
    frame = spark.createDataFrame([(1, "a", "Y"), (1, None, "X"), (2, "abc", None)], "k int, s string, flag string")
    checks = [rules.not_null("s"), rules.max_length("s", 2), rules.domain("flag", "Y", "N"), rules.minimum("k", 2)]
    assert rows(rules.check_rows(frame, "T", checks), "rule_name", "checked_rows", "failed_rows") == [
        ("DOMAIN_FLAG", 3, 1), ("LENGTH_S", 3, 1), ("MINIMUM_K", 3, 2), ("NOT_NULL_S", 3, 1),
    ]
    assert rows(rules.failing_rows(frame, checks), "k", "rule_name") == [
        (1, "DOMAIN_FLAG"), (1, "MINIMUM_K"), (1, "MINIMUM_K"), (1, "NOT_NULL_S"), (2, "LENGTH_S"),
    ]
    assert rows(rules.check_unique(frame, "T", ["k"]), "rule_name", "failed_rows") == [("UNIQUE_K", 1)]
    parents = spark.createDataFrame([(2,)], "id int")
    assert rows(rules.check_reference(frame, "T", "k", parents, "id"), "checked_rows", "failed_rows") == [(3, 2)]
    assert rows(rules.check_reference(frame.limit(0), "T", "k", parents, "id"), "checked_rows", "failed_rows") == [(0, 0)]


def test_run_log(spark):
    runs = spark.createDataFrame([(1, "P", "a"), (2, "P", "b"), (3, "P", "c")], "run_id bigint, pipeline_name string, source_name string")
    at = lambda minute: F.lit(f"2025-01-01 00:{minute:02d}:00").cast("timestamp")
    events = (
        audit.start_runs(runs, at(1))
        .unionByName(audit.finish_success(runs.where("run_id = 1"), 5, 4, 1, at(2)))
        .unionByName(audit.finish_failed(runs.where("run_id = 2"), "x" * 5000, at=at(0)))
    )
    states = audit.run_states(events)
    assert rows(states, "run_id", "status", "rows_read", "rows_loaded", "rows_rejected", F.length("error_message")) == [
        (1, "SUCCESS", 5, 4, 1, None), (2, "FAILED", 0, 0, 0, 5000), (3, "RUNNING", 0, 0, 0, None),
    ]
    assert states.columns == schemas.CONTROL["etl_run"].names


def test_attendance_reconciliation(spark):
    kind = "run_id bigint, session_raw_id bigint, participant_name string, email string, participant_id string, duration_seconds bigint, validation_status string"
    people = spark.createDataFrame([
        (1, 1, "A", "A@x", None, 100, "VALID"), (1, 1, "B", None, "7", 100, "VALID"), (1, 1, "C", None, None, 6, "VALID"),
        (1, 1, "D", None, None, 5, "VALID"), (1, 1, "E", None, None, 9, "INVALID"),
    ], kind)
    actions = spark.createDataFrame([
        (1, 1, "x", "a@X", None, 60, "VALID"), (1, 1, "y", "a@x", "9", 35, "VALID"), (1, 1, "z", None, "7", 200, "INVALID"),
        (1, 2, "c", None, None, 6, "VALID"),
    ], kind)
    report = reports.attendance_reconciliation(people, actions)
    assert rows(report, "participant_name", "calculated_activity_seconds", "difference_seconds", "reconciliation_status") == [
        ("A", 95, 5, "PASSED"), ("B", 0, 100, "WARNING"), ("C", 0, 6, "WARNING"), ("D", 0, 5, "PASSED"),
    ]


def test_facts_find_employees(spark):
    employees = spark.createDataFrame([(0, "UNKNOWN", "UNKNOWN"), (1, "a@x", "Ann"), (2, "b@x", "Bob"), (3, "c@x", "bob")], "employee_key bigint, employee_id string, employee_name string")
    sheet = spark.createDataFrame(
        [("r1", " A@X ", "P", dt.date(2025, 1, 2), 7.125, 1), ("r2", None, None, dt.date(2025, 1, 2), 8.0, 1), ("r3", "unknown", "Q", dt.date(2025, 1, 2), 8.0, 1),
         ("r4", "b@x", "P", dt.date(2025, 1, 2), 1000.0, 1)],
        "record_id string, email string, project_name string, work_date date, hours double, run_id bigint",
    )
    projects = spark.createDataFrame([(4, "P")], "project_key bigint, project_name string")
    work = facts.work_facts(sheet, employees, projects)
    assert rows(work, "source_record_id", "employee_key", "project_key", F.col("hours").cast("string"), "activity_type_key", "date_key") == [
        ("r1", 1, 4, "7.13", 1, 20250102), ("r2", 0, None, "8.00", 1, 20250102), ("r3", 0, None, "8.00", 1, 20250102),
        ("r4", 2, 4, "1000.00", 1, 20250102),
    ]
    exams = spark.createDataFrame([("e1", "ANN ", dt.date(2025, 1, 2), 2, 1), ("e2", "Bob", dt.date(2025, 1, 2), 2, 1), ("e3", None, dt.date(2025, 1, 2), 2, 1)],
                                  "record_id string, employee_name string, exam_date date, hours int, run_id bigint")
    assert rows(facts.exam_facts(exams, employees), "source_record_id", "employee_key") == [("e1", 1), ("e2", 0), ("e3", 0)]


def test_employee_master_takes_the_first_in_file_order(spark, tmp_path):
    one = spark.createDataFrame([(2, " Zed ", "Z@X"), (1, "Zoe", "z@x "), (3, "No", None)], "n int, name string, mail string")
    two = spark.createDataFrame([(1, "Early", "z@x"), (2, 'Ann "A", B', "a@x")], "n int, name string, mail string")
    sources = [master.people_list(one, "name", "mail", "n", 1), master.people_list(two, "name", "mail", "n", 2)]
    built = master.employee_master(sources)
    assert [(r.employee_name, r.employee_id, r.grade) for r in built.collect()] == [('Ann "A", B', "a@x", "JUNIOR"), ("Zoe", "z@x", "JUNIOR")]
    assert rows(master.rejected_people(sources), "employee_name", "error_code") == [("No", "NO_EMAIL")]
    loads.write_csv(built, str(tmp_path / "m"))
    assert rows(loads.read_csv(spark, str(tmp_path / "m"), built.schema), *built.columns) == rows(built, *built.columns)


def test_calendar(spark):
    days = dims.calendar(spark)
    assert days.count() == 4018
    first = days.where("full_date = '2021-01-01'").first()
    assert (first.date_key, first.day_name, first.week_number, first.month_name, first.is_weekend) == (20210101, "FRIDAY", 53, "JANUARY", "N")
    assert days.schema.names == schemas.TARGET["dim_date"].names


def test_input_files(spark, tmp_path):
    (tmp_path / "b.CSV").write_text("a,b\n1,2.5\n")
    (tmp_path / "a+ b.xlsx").write_text("x")
    (tmp_path / "c.txt").write_text("x")
    (tmp_path / "d.csv").write_text("")
    assert [r.file_name for r in files.find_input_files(spark, str(tmp_path)).collect()] == ["a+ b.xlsx", "b.CSV", "d.csv"]
    assert files.find_input_files(spark, str(tmp_path / "none")).count() == 0
    assert files.read_table(spark, str(tmp_path / "b.CSV")).dtypes == [("a", "int"), ("b", "double")]
    with pytest.raises(ValueError, match="unsupported"):
        files.read_table(spark, str(tmp_path / "c.txt"))


@pytest.mark.parametrize("costly", [False, True])
def test_costly_rows_get_the_same_numbers(spark, costly):
    frame = spark.range(300).select(F.col("id").cast("string").alias("k"))
    got = dict(rows(number_by_hash(frame, ["k"], "n", costly=costly), "k", "n"))
    order = sorted(got, key=lambda k: hashlib.sha256(k.encode()).hexdigest())
    assert [got[k] for k in order] == list(range(1, 301))


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_file_facts_meet_all_rows(spark, block_rows):
    from rollcall.sources.perfile import join_file_facts

    frame = spark.createDataFrame([(p, n) for p, last in (("a", 10), ("b", 1)) for n in range(1, last + 1)], "path string, n bigint")
    facts_of = spark.createDataFrame([("a", 10, "x"), ("b", 1, "y"), ("c", 5, "z")], "path string, last bigint, fact string")
    joined = join_file_facts(frame, facts_of, ["path"], "n", "last", block_rows)
    assert rows(joined, "path", "n", "fact") == sorted([("a", n, "x") for n in range(1, 11)] + [("b", 1, "y")], key=str)


@pytest.mark.parametrize("digits", [1, 2, 3, 4, 5])
def test_sums_down_the_digits_equal_one_window(spark, digits):
    keys = spark.range(2000).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, digits).alias("_bucket"))
    sizes = keys.groupBy("_bucket").count()
    found = {r["_bucket"]: r["_before"] for r in counts_before(sizes, digits).collect()}
    want, before = {}, 0
    for row in sorted(sizes.collect()):
        want[row["_bucket"]] = before
        before += row["count"]
    assert found == want


def test_no_window_sees_all_buckets(spark, monkeypatch):
    """With a row per bucket and five digits, every window of the numbering is partitioned and holds 256 parts at most."""
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 1)
    df = number_by_hash(spark.range(20_000).select(F.col("id").cast("string").alias("k")), ["k"], "n")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert sorted(r["n"] for r in df.collect()) == list(range(1, 20_001))
    prefixes = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("d"))
    for upper, lower in ((0, 2), (2, 4)):
        parts = prefixes.select(F.substring("d", 1, upper).alias("u"), F.substring("d", 1, lower).alias("l")).distinct().groupBy("u").count()
        assert parts.agg(F.max("count")).first()[0] <= 256


def byte_lines(spark, name, content):
    pieces = content.split(b"\n")
    pieces = pieces[:-1] if content.endswith(b"\n") else pieces
    rows = [(name, name, len(content), k + 1, bytearray(p), None) for k, p in enumerate(pieces)]
    return spark.createDataFrame(rows, "path string, file_name string, length bigint, line_number bigint, raw binary, wide string")


def test_content_hash_is_a_tree_over_all_lines(spark):
    lines = [f"line {k}".encode() for k in range(40)]
    variants = {
        "plain": b"\n".join(lines), "again": b"\n".join(lines), "feed": b"\n".join(lines) + b"\n", "swapped": b"\n".join([lines[1], lines[0], *lines[2:]]),
        "blocks": b"\n".join([*lines[4:8], *lines[:4], *lines[8:]]), "byte": b"\n".join([*lines[:-1], b"line 3X"]),
        "moved": b"\n".join([lines[0][:-1], lines[0][-1:] + lines[1], *lines[2:]]),
    }
    raw = None
    for name, content in variants.items():
        own = byte_lines(spark, name, content)
        raw = own if raw is None else raw.unionByName(own)
    for fan in (2, 4, 10_000):
        found = {r.path: r.source_file_hash for r in files.describe_byte_lines(raw, fan).collect()}
        assert found["plain"] == found["again"] and len(set(found.values())) == len(variants) - 1


def test_a_hash_by_hand(spark):
    sha = lambda text: hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
    leaves = [sha(b"%d|%s" % (k + 1, line)) for k, line in enumerate([b"a", b"b", b"c"])]
    blocks = [sha("".join(leaves[:2])), sha(leaves[2])]
    want = sha("5|" + sha(sha("".join(blocks))))
    assert files.describe_byte_lines(byte_lines(spark, "f", b"a\nb\nc"), 2).first().source_file_hash == want


def test_replaced_partitions_leave_the_others(spark, tmp_path):
    rows = spark.createDataFrame([(k, k % 4, "a") for k in range(40)], "id int, run_id int, v string")
    path = str(tmp_path / "t")
    loads.replace_partitions(rows, path, "run_id")
    before = {p: p.read_bytes() for p in (tmp_path / "t").rglob("*.parquet") if "run_id=2" not in str(p)}
    loads.replace_partitions(rows.where("run_id = 2 AND id < 20").withColumn("v", F.lit("b")), path, "run_id")
    assert {p: p.read_bytes() for p in before} == before
    found = sorted(map(tuple, spark.read.schema(rows.schema).parquet(path).where("run_id = 2").select(*rows.columns).collect()))
    assert found == [(2, 2, "b"), (6, 2, "b"), (10, 2, "b"), (14, 2, "b"), (18, 2, "b")]
    assert spark.read.parquet(path).count() == 35
