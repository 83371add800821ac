"""Profiles of arbitrary delimited files, with values worked out by hand."""

import pytest

from rollcall.sources.files import read_files
from rollcall.sources.profiles import candidate_files, inventory, profile_folder
from rollcall.sources.records import read_records

FILES = {
    # A narrow preamble, a header with a blank and a repeated cell, one short row, a trailing note.
    "a mixed.csv": (
        "Report;2025\n\nEmp ID;Full Name;;Level;Level;Manager\n1;Ann;x;J;K;Max\n2;Bob;x;J\n3;Cat;y;S;T;Max\n\nTotal;3\n"
    ).encode("cp1252"),
    # All required columns under aliases; quoted cells hold the delimiter and a line break.
    "b full.csv": (
        'employee number,Grade,Seniority,Department,Line-Manager,DU\n1,"A, B",x,"IT\nOps",M,U\n2,C,x,HR,M,U\n'
    ).encode("utf-8-sig"),
    # Tabs in UTF-16.
    "c tabs.csv": "employee_id\temail\n1\ta@x\n2\tb@x\n".encode("utf-16"),
    # Commas in more cells, bars in more rows of one width: bars win on the count.
    "d bars.csv": b"role|status\nx, y|1\np|2\nq, r, s|3\n",
    # Equal counts: the wider reading wins; equal widths too: the earlier delimiter.
    "e tie.csv": b"a;b,c;d,e\n1;2,3;4,5\n",
    "f tie.csv": b"a,b;c\n1,2;3\n",
    # No row has two cells.
    "g text.csv": b"just\nsome\ntext\n",
    # The hint row is the header although another row of the width comes first.
    "h late.csv": b"x1,x2,x3\nname,email,hours\nAnn,a@x,8\n",
    "i empty.csv": b"",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("profiles")
    for name, content in FILES.items():
        (path / name).write_bytes(content)
    return str(path)


def test_profile(spark, folder):
    profile = profile_folder(spark, folder)
    rows = {r.file_name: r for r in profile.collect()}
    assert set(rows) == set(FILES)

    a = rows["a mixed.csv"]
    assert (a.encoding, a.delimiter, a.table_width, a.header_row_number) == ("utf-8-sig", ";", 6, 3)
    assert (a.table_rows, a.skipped_rows) == (2, 2)
    assert a.columns == ["Emp ID", "Full Name", "unnamed_column_3", "Level", "Level_2", "Manager"]
    assert (a.employee_id, a.employee_name, a.grade, a.line_manager) == ("Emp ID", "Full Name", "Level", "Manager")
    assert (a.discipline, a.delivery_unit, a.complete_candidate, a.error) == (None, None, False, None)

    b = rows["b full.csv"]
    assert (b.delimiter, b.header_row_number, b.table_rows, b.skipped_rows) == (",", 1, 2, 0)
    assert (b.employee_id, b.grade, b.discipline, b.line_manager, b.delivery_unit) == (
        "employee number", "Grade", "Department", "Line-Manager", "DU",
    )
    assert b.columns == ["employee number", "Grade", "Seniority", "Department", "Line-Manager", "DU"]

    c = rows["c tabs.csv"]
    assert (c.encoding, c.delimiter, c.table_width, c.table_rows, c.employee_id) == ("utf-16-le", "\t", 2, 2, "employee_id")
    d = rows["d bars.csv"]
    assert (d.delimiter, d.table_width, d.header_row_number, d.table_rows) == ("|", 2, 1, 3)
    assert (rows["e tie.csv"].delimiter, rows["e tie.csv"].table_width) == (",", 3)
    assert (rows["f tie.csv"].delimiter, rows["f tie.csv"].table_width) == (",", 2)
    assert (rows["g text.csv"].error, rows["g text.csv"].delimiter) == ("NO_TABLE", None)
    h = rows["h late.csv"]
    assert (h.header_row_number, h.table_rows, h.columns) == (2, 1, ["name", "email", "hours"])
    assert rows["i empty.csv"].error == "EMPTY_FILE"
    assert [r.file_name for r in candidate_files(profile).collect()] == ["b full.csv"]


def test_inventory(spark, tmp_path):
    lines = ["n,x,flag,note,gap,none"] + [f"{i},{i}.5,True,t{i},{'' if i == 2 else i}," for i in range(7)]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    files, text = read_files(spark, str(tmp_path))
    row = inventory(read_records(text), files).first()
    assert (row.file_name, row.row_count, row.column_count) == ("t.csv", 7, 6)
    assert row.columns == ["n", "x", "flag", "note", "gap", "none"]
    assert row.column_types == ["int64", "float64", "bool", "object", "float64", "float64"]
    assert [r[0] for r in row.first_rows] == ["0", "1", "2", "3", "4"]
