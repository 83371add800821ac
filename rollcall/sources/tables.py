"""Tables with named columns out of delimited files of any layout (S17, U-CAT), and what timesheets hold.

Files differ in delimiter, header row and columns, so a schema is data: one row per file with its column
names and, for each field of its dataset, the column that holds it. Rows meet the schema of their file by file
and block of rows, and come out as a map from column name to cell, and with the same fields for all files;
a field that a file lacks is null. So files of all layouts are one table, read in one pass, and not a union
of as many scans as there are files.

A row is rejected, with a code, if its cells do not fit the header, or if its day or hours are no day and no
hours; a file is, if it has no table or lacks a column its dataset needs. Everything is a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.text import blank_to_null, col, normalise_email, normalise_header, normalise_name, strip
from rollcall.sources.perfile import join_file_facts
from rollcall.sources.profiles import find_headers, header_names, read_layout
from rollcall.storage import land


@dataclass(frozen=True)
class Dataset:
    """Files whose names begin alike, and the normalised headers, by priority, under which they carry a field."""

    name: str
    file_names: str
    aliases: dict[str, tuple[str, ...]]
    required: tuple[str, ...]

    @property
    def lists_people(self) -> bool:
        return {"employee_name", "email"} <= set(self.aliases)


_NAME = ("name", "employee_name", "full_name")
_EMAIL = ("email", "e_mail", "mail")
_HOURS = ("hours", "worked_hours", "absence_hours")
# How the names of the files begin, and that timesheets carry Name and Email and the exam schedule no email.
WORK = Dataset(
    "TIMESHEET_WORK", r"timesheet_+workedhours",
    {"employee_name": _NAME, "email": _EMAIL, "project_name": ("project", "project_name"), "day": ("date", "work_date", "day"), "hours": _HOURS},
    ("employee_name", "email", "day", "hours"),
)
ABSENCE = Dataset(
    "TIMESHEET_ABSENCE", r"timesheet_+absences", {"employee_name": _NAME, "email": _EMAIL, "day": ("date", "absence_date", "day"), "hours": _HOURS},
    ("employee_name", "email", "day", "hours"),
)
EXAM = Dataset(
    "EXAM_SCHEDULE", r"exam_+absences", {"employee_name": _NAME, "day": ("exam_date", "date", "day"), "hours": _HOURS}, ("employee_name", "day", "hours")
)
#: In the order in which people are taken from them.
DATASETS = (WORK, ABSENCE, EXAM)
FIELDS = ("employee_name", "email", "project_name", "day", "hours")


@dataclass(frozen=True)
class Tables:
    """``rows`` of all files with typed fields, and ``rejects`` (path, source_row_number, error_code, error_message, raw_record)."""

    rows: DataFrame
    rejects: DataFrame
    people: DataFrame


def dataset_of(file_name, datasets: tuple[Dataset, ...] = DATASETS) -> Column:
    """The name of the dataset a file belongs to, null for other files."""
    return reduce(lambda rest, d: F.when(col(file_name).rlike(f"(?i)^{d.file_names}.*\\.csv\\z"), F.lit(d.name)).otherwise(rest), reversed(datasets), F.lit(None).cast("string"))


def schemas(records: DataFrame, headers: DataFrame, files: DataFrame, datasets: tuple[Dataset, ...] = DATASETS) -> DataFrame:
    """One row per file with a table: path, file_name, source_file_hash, dataset, delimiter, width, header_row, last_row, columns, places, missing.

    ``places`` maps a field to the number of its column, from 1. Of the aliases of a field the first that is there
    counts, and of columns that share it the last. ``missing`` are the fields the dataset needs and the file lacks.
    """
    names = header_names(records, headers)
    listed = names.groupBy("path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "header"))), lambda s: s["header"]).alias("columns")
    )
    known = F.create_map(*(
        F.lit(x) for d in datasets for field, names in d.aliases.items() for rank, alias in enumerate(names) for x in (f"{d.name}|{alias}", f"{rank:02d}|{field}")
    ))
    kinds = files.select("path", "file_name", "source_file_hash", dataset_of("file_name", datasets).alias("dataset")).where("dataset IS NOT NULL")
    matched = names.join(kinds.select("path", "dataset"), "path").withColumn("match", F.try_element_at(known, F.concat_ws("|", "dataset", normalise_header("header"))))
    rank, field = F.substring_index("match", "|", 1).cast("int"), F.substring_index("match", "|", -1)
    best = matched.where("match IS NOT NULL").groupBy("path", field.alias("field")).agg(
        F.max_by("position", F.struct(-rank, F.col("position"))).cast("int").alias("position")
    )
    places = best.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("field", "position"))).alias("places"))
    needed = F.create_map(*(x for d in datasets for x in (F.lit(d.name), F.array(*map(F.lit, d.required)))))
    found = headers.join(kinds, "path").join(listed, "path").join(places, "path", "left")
    held = F.coalesce(F.map_keys("places"), F.array().cast("array<string>"))
    return found.withColumn("missing", F.array_except(needed[F.col("dataset")], held))


def named_rows(records: DataFrame, schema: DataFrame) -> DataFrame:
    """S17 for all files: path, file_name, source_file_hash, dataset, row_number, fits, cells, places and, where the row fits, ``named``.

    ``named`` maps column names to cells. Rows above the header and blank rows are left out.
    """
    of_file = ("path", "file_name", "source_file_hash", "dataset")
    facts = schema.select(*of_file, "delimiter", "width", "header_row", "last_row", "columns", "places")
    rows = join_file_facts(records, facts, ["path", "delimiter"], "row_number", "last_row")
    rows = rows.where((F.col("row_number") > F.col("header_row")) & F.exists("cells", lambda cell: strip(cell) != ""))
    fits = F.size("cells") == F.col("width")
    return rows.select(*of_file, "row_number", fits.alias("fits"), "cells", "places", F.when(fits, F.map_from_arrays("columns", "cells")).alias("named"))


def parse_day(text) -> Column:
    """A day as ``2025-06-24``, ``6/24/2025`` (month first, as in meeting exports) or ``24.6.2025``, a time of day behind it ignored; else null."""
    short = F.regexp_extract(strip(text), r"^([0-9]+[-/.][0-9]+[-/.][0-9]+)(?:[ T].*)?\z", 1)
    turned = F.regexp_replace(short, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z", "$3-$1-$2")
    turned = F.regexp_replace(turned, r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})\z", "$3-$2-$1")
    return F.when(turned.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), turned).try_cast("date")


def parse_hours(text) -> Column:
    """Hours as ``7.5``, ``7,5`` or ``7:30``; null for anything else, negative numbers included."""
    plain = strip(text)
    number = F.when(plain.rlike(r"^[0-9]{1,9}(?:[.,][0-9]{1,6})?\z"), F.replace(plain, F.lit(","), F.lit("."))).cast("decimal(24,6)")
    clock = F.when(plain.rlike(r"^[0-9]{1,9}:[0-5][0-9]\z"), plain)
    parts = F.split(clock, ":")
    return F.coalesce(number, (parts[0].cast("decimal(24,6)") + parts[1].cast("decimal(24,6)") / 60).cast("decimal(24,6)"))


def typed_rows(named: DataFrame) -> DataFrame:
    """``named_rows`` with the fields of all datasets, typed, and an ``error_code`` where one does not hold what it should."""
    of_row = ("path", "file_name", "source_file_hash", "dataset", "row_number")
    cell = lambda field: F.when(F.col("fits"), F.get("cells", F.try_element_at("places", F.lit(field)) - 1))
    rows = named.select(*of_row, "fits", *(cell(f).alias(f"{f}_raw") for f in FIELDS), F.to_json("cells").alias("raw_record"))
    typed = rows.select(
        *of_row, normalise_name("employee_name_raw").alias("employee_name"), normalise_email("email_raw").alias("email"),
        blank_to_null(strip("project_name_raw")).alias("project_name"), parse_day("day_raw").alias("work_date"), parse_hours("hours_raw").alias("hours"), "fits", "raw_record",
    )
    code = F.when(~F.col("fits"), "WIDTH").when(F.col("work_date").isNull(), "BAD_DAY").when(F.col("hours").isNull(), "BAD_HOURS")
    return typed.withColumn("error_code", code).drop("fits")


_MESSAGES = {
    "WIDTH": "The row has another number of cells than the header.", "BAD_DAY": "The day is missing or no date.",
    "BAD_HOURS": "The hours are missing or no number from 0 on.", "NO_TABLE": "The file has no table.",
    "EMPTY_FILE": "The file is empty.", "UNDECODABLE": "The file cannot be decoded.",
}


def read_tables(files: DataFrame, lines: DataFrame, datasets: tuple[Dataset, ...] = DATASETS) -> Tables:
    """All files of the datasets as one table. ``files`` and ``lines`` are those of ``sources.files``; other files are left alone."""
    files = files.withColumn("dataset", dataset_of("file_name", datasets)).where("dataset IS NOT NULL")
    layout, records = read_layout(lines)
    headers = land(find_headers(records, layout), "headers")
    schema = land(schemas(records, headers, files.drop("dataset"), datasets), "schemas")
    whole = schema.where(F.size("missing") == 0)
    rows = land(typed_rows(named_rows(records, whole)), "typed_rows")

    lacking = schema.where(F.size("missing") > 0).select("path", F.concat(F.lit("The file lacks "), F.array_join("missing", ", ")).alias("lacking"))
    by_file = files.join(schema.select("path", F.lit(True).alias("has_table")), "path", "left").join(lacking, "path", "left")
    file_code = F.coalesce("error", F.when(F.col("has_table").isNull(), "NO_TABLE"), F.when(F.col("lacking").isNotNull(), "MISSING_COLUMNS"))
    message = F.create_map(*(F.lit(x) for pair in _MESSAGES.items() for x in pair))
    whole_files = by_file.withColumn("error_code", file_code).where("error_code IS NOT NULL").select(
        "path", F.lit(None).cast("bigint").alias("source_row_number"), "error_code",
        F.coalesce("lacking", F.try_element_at(message, F.col("error_code"))).alias("error_message"), F.col("file_name").alias("raw_record"),
    )
    single = rows.where("error_code IS NOT NULL").select(
        "path", F.col("row_number").alias("source_row_number"), "error_code", F.try_element_at(message, F.col("error_code")).alias("error_message"), "raw_record"
    )
    return Tables(rows.where("error_code IS NULL").drop("error_code"), whole_files.unionByName(single), people(rows, datasets))


def people(rows: DataFrame, datasets: tuple[Dataset, ...] = DATASETS) -> DataFrame:
    """U-CAT: names and emails out of ``typed_rows`` of all files that list both, in the form of ``master.people_list``, in the order of datasets and file names.

    A row whose day or hours are bad still names a person; one that does not fit its header does not.
    """
    order = F.create_map(*(x for k, d in enumerate(datasets) if d.lists_people for x in (F.lit(d.name), F.lit(k + 2))))
    placed = rows.withColumn("file_order", F.try_element_at(order, F.col("dataset")))
    return placed.where(F.col("file_order").isNotNull() & F.coalesce(F.col("error_code") != "WIDTH", F.lit(True))).select(
        "file_order", "file_name", "row_number", "employee_name", F.col("email").alias("employee_id")
    )


def activity_rows(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """Rows of one dataset as the facts take them; a row is named by its file's content and its number."""
    record = F.concat_ws("|", "source_file_hash", F.col("row_number").cast("string"))
    kept = [c for c in rows.columns if c not in ("path", "dataset", "row_number", "file_name", "source_file_hash", "raw_record", "work_date")]
    day = F.col("work_date").alias("exam_date" if dataset is EXAM else "work_date")
    return rows.where(F.col("dataset") == dataset.name).select(record.alias("record_id"), day, *kept)
