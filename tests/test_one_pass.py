"""Meetings read in one pass over the lines, next to the reader of records."""

from pyspark.sql import functions as F

from rollcall.functions.text import label_bytes
from rollcall.sources import files, meetings
from rollcall.sources.files import read_file_records
from tests.test_meetings import export


def _frames(spark, tmp_path):
    for k, (encoding, delimiter) in enumerate((("utf-8", ","), ("utf-16", "\t"), ("cp1252", ";"))):
        people = [["Øyvind, Jr.", "a", "", "1h", "o@x.com", "", "x"], ['Q "Q"', "b", "", "2m", "", "P2", ""], ["", "", "", "3s", "", "", ""]]
        (tmp_path / f"Meeting{k}.csv").write_bytes(export(people=people, delimiter=delimiter, encoding=encoding)[0])
        people[0][0] = "Line\nBreak"
        (tmp_path / f"Meeting{k + 3}.csv").write_bytes(export(people=people, delimiter=delimiter, encoding=encoding)[0])
    return files.describe_files(spark, str(tmp_path), "Meeting*.csv")


def _all(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_one_pass_gives_what_the_reader_of_records_gives(spark, tmp_path):
    found, raw = _frames(spark, tmp_path)
    records = read_file_records(raw, found)
    one, plain = meetings.parse_files(found, raw), meetings.parse_meetings(found.select(*files.FILE_COLUMNS), records)
    for name in ("participants", "activities", "rejects", "extents"):
        assert _all(getattr(one, name)) == _all(getattr(plain, name)), name
    assert one.participants.count() == 12
    columns = ["Name", "Email"]
    assert _all(meetings.fixed_offset_files(found, raw, columns)) == _all(meetings.fixed_offset(records, columns))


def test_lines_meet_their_file_once(spark, tmp_path):
    """Records are not joined again to find sections and headers, which would move every line three times more."""
    found, raw = _frames(spark, tmp_path)
    rows = files.records_by_line(raw, found.select("path", "encoding", "delimiter", "last_line"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_lines_that_may_hold_a_label(spark):
    rows = [(1, "Meeting TITLE".encode("utf-16-le"), True), (2, "Naﬀ".encode(), True), (3, "Pér 5".encode(), False), (4, "rolle".encode("utf-16-be"), False), (5, "duraſ".encode("utf-16-le"), True), (6, None, None)]
    frame = spark.createDataFrame([(n, None if b is None else bytearray(b)) for n, b, _ in rows], "n int, b binary")
    got = {r.n: r.m for r in frame.select("n", label_bytes(F.col("b"), ("title", "role")).alias("m")).collect()}
    assert {n: got[n] for n, _, _ in rows if n != 6} == {n: m for n, _, m in rows if n != 6} and not got[6]
