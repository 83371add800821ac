"""Meeting exports: the three sections, encodings, delimiters, quoting and rejects."""

import csv
import random
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from rollcall.functions.text import normalise_label
from rollcall.sources.files import decode, read_files, whole_lines
from rollcall.sources.meetings import fixed_offset, read_meetings
from rollcall.sources.records import number_records, read_records, split_cells

PEOPLE = ["Name", "First Join", "Last Leave", "In-Meeting Duration", "Email", "Participant ID (UPN)", "Role"]
ACTIONS = ["Name", "Join Time", "Leave Time", "Duration", "Email", "Participant ID", "Role"]


def export(title="Théory", people=None, actions=None, delimiter=",", encoding="utf-8", extra=()):
    people = people if people is not None else [
        ["Ann Example", "3/4/26, 9:05:00 AM", "3/4/26, 10:20:00 AM", "1h 15m 0s", "Ann@Example.com", "K-17", "Speaker"]
    ]
    actions = actions if actions is not None else [
        ["Ann Example", "3/4/26, 9:05:00 AM", "3/4/26, 9:25:00 AM", "20m 0s", "Ann@Example.com", "K-17", "Speaker"],
        ["Ann Example", "3/4/26, 9:25:40 AM", "3/4/26, 10:20:40 AM", "55m 0s", "Ann@Example.com", "K-17", "Speaker"],
    ]
    out = io.StringIO()
    quoting = csv.QUOTE_ALL if delimiter in ";|" else csv.QUOTE_MINIMAL
    writer = csv.writer(out, delimiter=delimiter, lineterminator="\r\n", quoting=quoting)
    rows = [
        ["1. Summary"], ["Meeting title", title], ["Attended participants", str(len(people))],
        ["Start time", "3/4/26, 8:58:30 AM"], ["End time", "3/4/26, 10:31:02 AM"],
        ["Meeting duration", "1h 32m 32s"], ["Average attendance time", "1h 15m 0s"], *extra, [],
        ["2. Participants"], PEOPLE, *people, [], ["3. In-Meeting Activities"], ACTIONS, *actions,
    ]
    writer.writerows(rows)
    return out.getvalue().encode(encoding), rows


def test_three_sections(spark, tmp_path):
    content, _ = export()
    (tmp_path / "Meeting1 1.csv").write_bytes(content)
    meetings = read_meetings(spark, str(tmp_path))
    session = meetings.sessions.first()
    assert session.meeting_title_raw == "Théory"
    assert session.attended_participants_raw == "1"
    assert session.source_file_name == "Meeting1 1.csv"
    assert len(session.source_file_hash) == 64
    assert session.session_source_key == hashlib.sha256("théory|3/4/26, 8:58:30 AM".encode()).hexdigest()
    (person,) = meetings.participants.collect()
    assert person.participant_id_raw == "K-17"
    assert person.source_row_number == 11
    assert person.first_join_raw == "3/4/26, 9:05:00 AM"
    actions = meetings.activities.orderBy("source_row_number").collect()
    assert [a.duration_raw for a in actions] == ["20m 0s", "55m 0s"]
    assert meetings.rejects.isEmpty()


CASES = [
    ("utf-8", ","), ("utf-8-sig", ";"), ("utf-16", "\t"), ("utf-16-be", "\t"), ("cp1252", "|"), ("cp1252", ","),
]


def _write_cases(folder):
    expected = {}
    for index, (encoding, delimiter) in enumerate(CASES):
        title = f"Café Straße {index}"
        people = [
            ["Øyvind, Jr.", "3/4/26, 9:05:00 AM", "", "1h", "o@x.com", "", "x"],
            ['Quote "Q" Person', "3/4/26, 9:05:00 AM", "", "2m", "", "P2", ""],
            ["Line\nBreak", "3/4/26, 9:05:00 AM", "", "3s", "", "", ""],
            ["After", "3/4/26, 9:05:00 AM", "", "", "a@x.com", "", ""],
        ]
        content, rows = export(title, people, delimiter=delimiter, encoding=encoding)
        if encoding == "utf-16-be":
            content = b"\xfe\xff" + content
        (folder / f"Meeting{index}.csv").write_bytes(content)
        text = content.decode({"utf-16-be": "utf-16"}.get(encoding, encoding))
        sample = text[:10_000].replace("\r\n", "\n")
        try:
            chosen = "\t" if "\t" in sample else csv.Sniffer().sniff(sample, ";|,").delimiter
        except csv.Error:
            chosen = ","
        expected[f"Meeting{index}.csv"] = (list(csv.reader(io.StringIO(text, newline=""), delimiter=chosen)), chosen)
    return expected


def test_encodings_delimiters_and_quoting(spark, tmp_path):
    expected = _write_cases(tmp_path)
    files, lines = read_files(spark, str(tmp_path), "Meeting*.csv")
    found = {r.file_name: r for r in files.collect()}
    for index, (encoding, delimiter) in enumerate(CASES):
        row = found[f"Meeting{index}.csv"]
        assert row.delimiter == delimiter, row
        assert row.encoding == {"utf-8": "utf-8-sig", "utf-16": "utf-16-le"}.get(encoding, encoding)
        assert row.error is None
    records = read_records(lines).join(files.select("path", "file_name"), "path")
    got = {}
    for r in records.orderBy("file_name", "row_number").collect():
        got.setdefault(r.file_name, []).append((r.row_number, list(r.cells)))
    assert len({chosen for _, chosen in expected.values()}) > 2
    for name, (rows, _) in expected.items():
        assert got[name] == [(i + 1, row) for i, row in enumerate(rows)], name


ODD_FILES = {
    "without_end.csv": b"a,b\nc,d", "with_end.csv": b"a,b\nc,d\n", "late_tab.csv": "\n".join(["é" * 60] * 30 + ["x\ty"]).encode(),
    "two_bytes.csv": "Ċa,b\nc,Ċ\u0a05\u0100\n".encode("utf-16"), "two_bytes_be.csv": b"\xfe\xff" + "Ċa,b\n\u0a05\u0100,d".encode("utf-16-be"),
    "broken.csv": b"\xff\xfe" + "a\n".encode("utf-16-le") + b"\x00\xd8" + "b\n".encode("utf-16-le"),
    "pair.csv": "a,\U0001f600\n".encode("utf-16"), "bare_cr.csv": b"a,b\rc,d\r\ne,f\rg,h\r", "odd_size.csv": b"\xff\xfea,b",
}


@pytest.mark.parametrize("split_bytes", ["128m", "1k"])
def test_odd_files_whatever_the_size_of_a_task(spark, tmp_path, split_bytes):
    for name, content in ODD_FILES.items():
        (tmp_path / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        files, lines = read_files(spark, str(tmp_path), "*.csv")
        facts = {r.file_name: r for r in files.collect()}
        found = {}
        for r in lines.join(files.select("path", "file_name"), "path").orderBy("file_name", "line_number").collect():
            found.setdefault(r.file_name, []).append((r.line_number, r.line.rstrip("\r")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {n: f.length for n, f in facts.items()} == {n: len(c) for n, c in ODD_FILES.items()}
    assert len({f.source_file_hash for f in facts.values()}) == len(ODD_FILES)
    assert facts["late_tab.csv"].delimiter == "\t" and facts["with_end.csv"].delimiter == ","
    assert facts["broken.csv"].error == "UNDECODABLE" and "broken.csv" not in found
    for name, encoding in (("two_bytes.csv", "utf-16"), ("two_bytes_be.csv", "utf-16"), ("pair.csv", "utf-16"), ("with_end.csv", "utf-8"), ("without_end.csv", "utf-8"), ("odd_size.csv", "cp1252"), ("late_tab.csv", "utf-8")):
        text = ODD_FILES[name].decode(encoding)
        assert found[name] == list(enumerate(text.removesuffix("\n").split("\n"), 1)), name
    assert found["bare_cr.csv"] == [(1, "a,b"), (2, "c,d"), (3, "e,f"), (4, "g,h")]


def test_lines_of_two_byte_files_with_any_characters(spark):
    """Line feeds among characters whose halves look like them, with and without one at the end, in both byte orders."""
    rng, rows, want = random.Random(8), [], {}
    for k in range(240):
        plain = k % 3 == 0
        text = "".join(rng.choice("ab,\n\n\r" if plain else "a\n\n\u0a0a\u0a41\u410a\u0100\u0001é") for _ in range(rng.randrange(1, 25)))
        mark, encoding = ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))[k % 2]
        content, name = mark + text.encode(encoding), f"f{k}"
        pieces = content.split(b"\n")
        pieces = pieces[:-1] if content.endswith(b"\n") else pieces
        rows += [(name, name, len(content), n, bytearray(piece)) for n, piece in enumerate(pieces, 1)]
        want[name] = [line.encode(encoding) for line in text.removesuffix("\n").split("\n")]
        want[name][0] = mark + want[name][0]
    raw = spark.createDataFrame(rows, "path string, file_name string, length bigint, line_number bigint, raw binary")
    found = {}
    for r in whole_lines(raw).orderBy("path", "line_number").collect():
        found.setdefault(r.path, []).append(bytes(r.raw))
        assert r.line_number == len(found[r.path])
    assert found == want


def test_the_hash_follows_the_bytes_and_not_the_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\n" * 500)
    (tmp_path / "b.csv").write_bytes(b"x,y\n" * 500)
    (tmp_path / "c.csv").write_bytes(b"x,y\n" * 250 + b"y,x\n" * 250)
    hashes = []
    for split_bytes in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        hashes.append({r.file_name: r.source_file_hash for r in read_files(spark, str(tmp_path))[0].collect()})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert hashes[0] == hashes[1] and hashes[0]["a.csv"] == hashes[0]["b.csv"] != hashes[0]["c.csv"]


def test_empty_and_broken_files_are_rejected_and_the_rest_goes_on(spark, tmp_path):
    good, _ = export()
    (tmp_path / "Meeting1.csv").write_bytes(good)
    (tmp_path / "Meeting2.csv").write_bytes(b"")
    (tmp_path / "Meeting3.csv").write_bytes(b"just text\n")
    swapped = good.replace(b"2. Participants", b"9. x").replace(b"1. Summary", b"2. Participants").replace(b"9. x", b"1. Summary")
    (tmp_path / "Meeting4.csv").write_bytes(swapped)
    (tmp_path / "Meeting5.csv").write_bytes(good.replace(b"Start time", b"Begin"))
    (tmp_path / "Meeting6.csv").write_bytes(good.replace(b"Name,Join Time,Leave Time,Duration,Email,Participant ID,Role", b"a,b,c,d,e,f,g"))
    (tmp_path / "Meeting7.csv").write_bytes(good.replace(b"Ann Example,", b'"' + b"x" * 1_000_000 + b'",', 1))
    (tmp_path / "Meeting8.csv").write_bytes(good + b'"open' + b"y\n" * 90_000)
    meetings = read_meetings(spark, str(tmp_path))
    # A field of a megabyte is a field.
    assert sorted(s.source_file_name for s in meetings.sessions.collect()) == ["Meeting1.csv", "Meeting7.csv"]
    assert sorted(len(p.participant_name_raw) for p in meetings.participants.collect()) == [11, 1_000_000]
    rejects = {r.raw_record: (r.error_code, r.error_message) for r in meetings.rejects.collect()}
    assert rejects["Meeting2.csv"][0] == "EMPTY_FILE" and "empty" in rejects["Meeting2.csv"][1]
    assert rejects["Meeting3.csv"] == ("SECTION_MISSING", "Section not found: 1. Summary, 2. Participants, 3. In-Meeting Activities")
    assert rejects["Meeting4.csv"][0] == "SECTION_ORDER"
    assert rejects["Meeting5.csv"] == ("SUMMARY_INCOMPLETE", "Missing summary fields: start_time_raw")
    assert rejects["Meeting6.csv"][0] == "HEADER_MISSING"
    assert rejects["Meeting8.csv"][0] == "UNCLOSED_QUOTE"


def test_rows_without_identity_are_rejected(spark, tmp_path):
    people = [["", "3/4/26, 9:05:00 AM", "", "1h", " ", "", "Speaker"], ["B"], ["  ", ""]]
    (tmp_path / "Meeting1.csv").write_bytes(export(people=people)[0])
    meetings = read_meetings(spark, str(tmp_path))
    (person,) = meetings.participants.collect()
    assert (person.participant_name_raw, person.email_raw, person.role_raw) == ("B", "", "")
    (reject,) = meetings.rejects.collect()
    assert (reject.error_code, reject.source_row_number) == ("NO_IDENTITY", 11)


def test_no_meeting_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_meetings(spark, str(tmp_path))


ROWS = [
    'a,b,c', 'a,"b,c",d', '"x""y",z', 'a"b,c"', '"ab"cd,e', ',,', '"",""', 'a,"open', 'more "" text', 'end",b', '',
    '"multi', '', 'x","again', 'y",z', 'tail,"', '"', '""",q', 'q"', 'p;"q', "'a,b'", '"a" ,b', ' "a,b"', 'last,"never closed',
]


def test_records_match_the_standard_reader(spark):
    """Any split of the quoting over lines and blocks gives the records of Python's reader."""
    for start in range(0, len(ROWS)):
        text = ROWS[start:] + ROWS[:start]
        want = list(csv.reader(line + "\n" for line in text))
        # The reader keeps the line feed of a field that the end of the file cuts off.
        want = [[cell[:-1] if cell.endswith("\n") and i == len(want) - 1 else cell for cell in row] for i, row in enumerate(want)]
        frame = spark.createDataFrame([("p", i + 1, line, ",") for i, line in enumerate(text)], "path string, line_number bigint, line string, delimiter string")
        if start % 6 == 0:
            rows = read_records(frame).orderBy("row_number").collect()
            # A quote that is open at the end of the file is no record but a mark.
            if rows[-1].unclosed:
                assert list(rows[-1].cells) == []
                want[-1] = []
            assert [list(r.cells) for r in rows] == want and not any(r.unclosed for r in rows[:-1]), start
        numbers = [r.row_number for r in number_records(frame, block_lines=3).orderBy("line_number").collect()] if start % 6 == 1 else None
        if numbers:
            assert numbers == [r.row_number for r in number_records(frame).orderBy("line_number").collect()]
            assert max(numbers) == len(want)


def test_split_cells_on_every_delimiter(spark):
    for delimiter in ",;|\t":
        text = delimiter.join(["a", '"b' + delimiter + '""c"', "", "d"])
        row = spark.createDataFrame([(text, delimiter)], "t string, d string").select(split_cells(F.col("t"), F.col("d")).alias("c")).first()
        assert list(row.c) == ["a", "b" + delimiter + '"c', "", "d"]


def test_fixed_offset_reads_past_the_table(spark, tmp_path):
    (tmp_path / "Meeting1.csv").write_bytes(export(delimiter="\t", encoding="utf-16")[0])
    _, lines = read_files(spark, str(tmp_path), "Meeting*.csv")
    rows = fixed_offset(read_records(lines), ["Name", "Email"]).orderBy("row_number").collect()
    assert rows[0].name == "Ann Example" and rows[0].email == "Ann@Example.com"
    assert [r.name for r in rows[1:3]] == ["3. In-Meeting Activities", "Name"]


def test_characters_are_replaced_without_a_letter_map(spark):
    """Letter by letter replacement takes a large part of the time in which lines become rows."""
    frame = spark.createDataFrame([("a\u0000b,c", "xé\u0080".encode("latin-1")), ("\u0000", b"plain")], "t string, raw binary")
    cells = frame.select(split_cells(F.col("t"), F.lit(",")).alias("cells"), normalise_label("t").alias("label"))
    assert [(r["cells"], r["label"]) for r in cells.collect()] == [(["ab", "c"], "ab c"), ([], "")]
    assert "translate(t" not in cells._jdf.queryExecution().toString()
    letters = frame.select(decode(F.col("raw"), F.lit("cp1252")).alias("text"))
    assert [r["text"] for r in letters.collect()] == ["xé€", "plain"]
