"""Files of different layouts as one table, from folder to facts, with values worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.operators.loads import Store
from rollcall.plans import batch, timesheets
from rollcall.sources import tables
from rollcall.sources.files import read_files

FILES = {
    "Timesheet__WorkedHours 1.csv": (
        "Hours of June;all\n\nName;Email;Project;Date;Hours\nAnn Lée; ANN@x.com ;Apollo;2025-06-24;7,5\n\"Bob\nBaker\";bob@x.com;;6/25/2025;8\n"
        "Cat;cat@x.com;Apollo;26.6.2025 08:00;0:30\nDan;dan@x.com;Zeus;;8\nEve;eve@x.com;Zeus;2025-06-31;8\nFay;fay@x.com;Zeus;2025-06-24;-1\nGus;gus@x.com;Zeus\n"
    ).encode("cp1252"),
    "timesheet_workedhours 2.CSV.csv": "Worked Hours,Work Date,Full Name,Project Name,E-Mail,Mail\n1.25,2025-06-24,Other Ann,Hera,old@x.com,ann@x.com\n".encode("utf-8-sig"),
    "Timesheet_Absences 1.csv": "Name\tEmail\tAbsence Date\tAbsence Hours\nHal\thal@x.com\t2025-06-24\t8\nNobody\t\t2025-06-24\t4\n".encode("utf-16"),
    "Timesheet_Absences 2.csv": b"Name,Email,Reason\nIda,ida@x.com,sick\n",
    "Timesheet_Absences 3.csv": b"",
    "Exam_Absences 1.csv": b"Name|Exam Date|Hours\nann L\xc3\xa9e|2025-06-27|2\nHal|2025-06-27|2\nHAL|2025-06-28|1\nZoe|2025-06-28|1\n",
    "other.csv": b"Name,Email,Date,Hours\nMax,max@x.com,2025-06-24,1\n",
}


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for name, content in FILES.items():
        (path / name).write_bytes(content)
    return path


def test_rows_of_all_layouts_have_the_same_fields(spark, folder):
    found = tables.read_tables(*read_files(spark, str(folder)))
    rows = {(r.file_name, r.row_number): r for r in found.rows.collect()}
    assert len(rows) == 10 and {r.dataset for r in rows.values()} == {"TIMESHEET_WORK", "TIMESHEET_ABSENCE", "EXAM_SCHEDULE"}
    ann = rows["Timesheet__WorkedHours 1.csv", 4]
    assert (ann.employee_name, ann.email, ann.project_name, ann.work_date, ann.hours) == ("Ann Lée", "ann@x.com", "Apollo", date(2025, 6, 24), Decimal("7.500000"))
    bob, cat = rows["Timesheet__WorkedHours 1.csv", 5], rows["Timesheet__WorkedHours 1.csv", 6]
    assert (bob.employee_name, bob.project_name, bob.work_date) == ("Bob\nBaker", None, date(2025, 6, 25))
    assert (cat.work_date, cat.hours) == (date(2025, 6, 26), Decimal("0.500000"))
    other = rows["timesheet_workedhours 2.CSV.csv", 2]
    assert (other.email, other.project_name, other.hours) == ("old@x.com", "Hera", Decimal("1.250000"))  # "email" is not there, "e_mail" comes before "mail"
    exam = rows["Exam_Absences 1.csv", 2]
    assert (exam.employee_name, exam.email, exam.project_name, exam.work_date) == ("ann Lée", "", None, date(2025, 6, 27))
    rejects = {(r.raw_record if r.source_row_number is None else r.source_row_number, r.error_code) for r in found.rejects.collect()}
    assert rejects == {
        (7, "BAD_DAY"), (8, "BAD_DAY"), (9, "BAD_HOURS"), (10, "WIDTH"), ("Timesheet_Absences 2.csv", "MISSING_COLUMNS"), ("Timesheet_Absences 3.csv", "EMPTY_FILE"),
    }
    people = {(p.employee_id, p.file_order) for p in found.people.collect()}
    assert people == {(f"{n}@x.com", 2) for n in ("ann", "bob", "cat", "dan", "eve", "fay", "old")} | {("hal@x.com", 3), ("", 3)}


def test_cells_under_the_names_of_their_columns(spark, folder):
    from rollcall.sources.profiles import find_headers, read_layout

    files, lines = read_files(spark, str(folder))
    layout, records = read_layout(lines)
    schema = tables.schemas(records, find_headers(records, layout), files)
    named = {(r.file_name, r.row_number): r.named for r in tables.named_rows(records, schema).where("fits").collect()}
    assert named["Timesheet_Absences 2.csv", 2] == {"Name": "Ida", "Email": "ida@x.com", "Reason": "sick"}
    assert named["Exam_Absences 1.csv", 5] == {"Name": "Zoe", "Exam Date": "2025-06-28", "Hours": "1"}
    missing = {r.file_name: r.missing for r in schema.collect()}
    assert missing["Timesheet_Absences 2.csv"] == ["day", "hours"] and missing["Exam_Absences 1.csv"] == []


def test_timesheets_from_folder_to_facts(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"), digits=1)
    assert timesheets.load_timesheets(spark, str(folder), store) == 1
    target = schemas.TARGET
    read = lambda: store.rows("fact_employee_activity", target["fact_employee_activity"])
    facts = read().join(store.version("dim_employee", target["dim_employee"]), "employee_key").join(
        store.version("dim_project", target["dim_project"]), "project_key", "left"
    )
    shown = facts.select("employee_id", "date_key", "activity_type_key", "project_name", F.col("hours").cast("string")).collect()
    assert sorted(map(tuple, shown), key=str) == sorted([
        ("ann@x.com", 20250624, 1, "Apollo", "7.50"), ("bob@x.com", 20250625, 1, None, "8.00"), ("cat@x.com", 20250626, 1, "Apollo", "0.50"),
        ("old@x.com", 20250624, 1, "Hera", "1.25"), ("hal@x.com", 20250624, 2, None, "8.00"), ("UNKNOWN", 20250624, 2, None, "4.00"),
        ("ann@x.com", 20250627, 4, None, "2.00"), ("hal@x.com", 20250627, 4, None, "2.00"), ("hal@x.com", 20250628, 4, None, "1.00"), ("UNKNOWN", 20250628, 4, None, "1.00"),
    ], key=str)
    runs = {r.source_name: (r.status, r.rows_read, r.rows_loaded, r.rows_rejected) for r in batch.run_table(store).collect()}
    assert runs["Timesheet__WorkedHours 1.csv"] == ("SUCCESS", 7, 3, 4) and runs["Exam_Absences 1.csv"] == ("SUCCESS", 4, 4, 0)
    assert runs["Timesheet_Absences 2.csv"][0] == runs["Timesheet_Absences 3.csv"][0] == "FAILED" and "other.csv" not in runs
    codes = [e.error_code for e in store.rows("etl_error_log_ingest", schemas.CONTROL["etl_error_log"]).collect()]
    assert sorted(codes) == ["BAD_DAY", "BAD_DAY", "BAD_HOURS", "EMPTY_FILE", "MISSING_COLUMNS", "WIDTH"]
    assert {p.project_name for p in store.version("dim_project", target["dim_project"]).collect()} == {"Apollo", "Hera"}

    # The same files and a copy add nothing; a mended one is new.
    (folder / "Exam_Absences copy.csv").write_bytes(FILES["Exam_Absences 1.csv"])
    (folder / "Timesheet_Absences 2.csv").write_bytes(b"Name,Email,Day,Hours\nIda,ida@x.com,2025-06-24,3\n")
    assert timesheets.load_timesheets(spark, str(folder), store) == 2
    assert read().count() == 11 and store.highest("activity_key") == 11
    assert {e.employee_id for e in store.version("dim_employee", target["dim_employee"]).collect()} >= {"ida@x.com", "ann@x.com", "UNKNOWN"}
