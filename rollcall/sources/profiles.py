"""Profiles of arbitrary delimited files.

The cells of every line are counted under each of four delimiters, in one pass; the delimiter with the most regular
layout wins, and the file is cut into records under it alone. The header
is looked for among the rows of the dominant width, and its columns are matched with the employee
attributes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.functions.text import normalise_header, strip
from rollcall.sources.files import read_files
from rollcall.sources.perfile import join_file_facts
from rollcall.sources.records import cell_counts, read_records
from rollcall.storage import land

# Delimiters, header words, column aliases by priority, and required columns.
DELIMITERS = (",", ";", "\t", "|")
HEADER_HINTS = (
    "name", "employee", "employee_id", "email", "grade", "discipline", "manager", "line_manager",
    "delivery_unit", "project", "date", "hours", "duration", "attendance", "status", "role", "join",
    "leave", "participant",
)
COLUMN_ALIASES = {
    "employee_id": (
        "employee_id", "employeeid", "employee_code", "employee_number", "emp_id", "resource_id",
        "worker_id", "person_id",
    ),
    "employee_name": ("employee_name", "employeename", "full_name", "fullname"),
    "grade": ("grade", "employee_grade", "level", "seniority"),
    "discipline": ("discipline", "department", "capability", "competency", "practice"),
    "line_manager": (
        "line_manager", "linemanager", "manager", "manager_name", "manager_id", "manager_email",
        "supervisor",
    ),
    "delivery_unit": ("delivery_unit", "deliveryunit", "du", "business_unit", "businessunit", "unit"),
}
REQUIRED_COLUMNS = ("employee_id", "grade", "discipline", "line_manager", "delivery_unit")
FOLLOWING_ROWS = 5

_BLOCK_ROWS = 10_000


def _filled(cells="cells") -> Column:
    return F.exists(cells, lambda cell: strip(cell) != "")


def choose_layout(lines: DataFrame) -> DataFrame:
    """Per file the delimiter and dominant width: path, delimiter, width, last_row, last_line, spans.

    Widths above one are counted per delimiter; the dominant width is the most frequent, the wider
    of equals. The delimiter with the best (count, width, rows with several columns) wins, and the
    earlier one in the list of equals. A reading with a quote that is never closed does not take part.

    One pass over the lines counts the cells under all delimiters. Where a line leaves a field open, that
    file is cut into records under that delimiter before its cells are counted; ``spans`` tells such a reading.
    """
    counts = F.col("filled") & (F.col("width") > 1)
    own = cell_counts(lines.select("path", "line_number", "line"), DELIMITERS).groupBy("path", "delimiter", "width", counts.alias("counts")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_or("opens").alias("opens"), F.max("line_number").alias("last_row")
    )
    own = land(own, "widths")
    spanning = land(own.where("opens").select("path", "delimiter").distinct(), "spanning_readings")
    histogram = own.withColumn("unclosed", F.lit(False)).drop("opens")
    if not spanning.isEmpty():
        extents = own.groupBy("path").agg(F.max("last_row").alias("last_row"))
        pairs = spanning.join(extents, "path")
        again = join_file_facts(lines.select("path", "line_number", "line"), pairs, ["path"], "line_number", "last_row")
        records = read_records(again.drop("last_row"), ["delimiter"], spanning)
        width = F.size("cells")
        cut = records.groupBy("path", "delimiter", width.alias("width"), (_filled() & (width > 1)).alias("counts")).agg(
            F.count(F.lit(1)).alias("n"), F.max("row_number").alias("last_row"), F.bool_or("unclosed").alias("unclosed")
        )
        histogram = histogram.join(spanning, ["path", "delimiter"], "left_anti").unionByName(cut)
    dominant = (
        histogram.groupBy("path", "delimiter")
        .agg(
            F.max(F.when(F.col("counts"), F.struct("n", "width"))).alias("top"),
            F.sum(F.when(F.col("counts"), F.col("n"))).alias("multi"),
            F.bool_or("unclosed").alias("unclosed"),
            F.max("last_row").alias("last_row"),
        )
        .where(F.col("top").isNotNull() & ~F.col("unclosed"))
    )
    order = F.array_position(F.array(*[F.lit(d) for d in DELIMITERS]), F.col("delimiter"))
    best = F.max_by(F.struct("delimiter", "top.width", "last_row"), F.struct("top.n", "top.width", "multi", -order))
    chosen = dominant.groupBy("path").agg(best.alias("b")).select("path", "b.delimiter", "b.width", "b.last_row")
    last_lines = own.groupBy("path").agg(F.max("last_row").alias("last_line"))
    known = spanning.withColumn("spans", F.lit(True))
    return chosen.join(last_lines, "path").join(known, ["path", "delimiter"], "left").withColumn("spans", F.coalesce("spans", F.lit(False)))


def read_layout(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(layout, records)`` of files: how each is laid out, and its records under the delimiter that won, both landed."""
    layout = land(choose_layout(lines), "layout")
    won = join_file_facts(
        lines.select("path", "line_number", "line"), layout.select("path", "delimiter", "last_line"), ["path"], "line_number", "last_line"
    )
    records = read_records(won.drop("last_line"), spanning=layout.where("spans").select("path"))
    return layout, land(records, "records")


def find_headers(records: DataFrame, layout: DataFrame) -> DataFrame:
    """Per file the header row among the rows of the dominant width.

    The rows after a candidate are looked at in blocks of rows; the first rows of a block are also
    given to the block before, so that no window holds a whole file.
    """
    facts = layout.select("path", "delimiter", "width", "last_row")
    rows = join_file_facts(records, facts, ["path", "delimiter"], "row_number", "last_row").select(
        "path", "delimiter", "width", "last_row", "row_number", "cells", (_filled() & (F.size("cells") == F.col("width"))).alias("fits")
    )
    # Only cells of fitting rows are scored; other rows are needed for their position.
    normalised = F.transform("cells", normalise_header)
    hints = F.array(*[F.lit(h) for h in HEADER_HINTS])
    # A cell that equals a hint, or has one among its words.
    hit = F.filter(normalised, lambda c: F.array_contains(hints, c) | F.arrays_overlap(F.split(c, "_"), hints))
    letters = F.filter("cells", lambda c: c.rlike(r"\p{L}"))
    scored = rows.select(
        "path", "delimiter", "width", "last_row", "row_number", "fits",
        F.when(F.col("fits"), F.size(hit)).alias("hints"),
        F.when(F.col("fits"), F.size(letters)).alias("letters"),
    )
    own = F.floor((F.col("row_number") - 1) / _BLOCK_ROWS)
    before = F.floor((F.col("row_number") - 1 - FOLLOWING_ROWS) / _BLOCK_ROWS)
    blocks = scored.withColumn("own", own).withColumn("block", F.explode(F.array_distinct(F.array(own, before))))
    following = Window.partitionBy("path", "block").orderBy("row_number").rowsBetween(1, FOLLOWING_ROWS)
    candidates = (
        blocks.withColumn("followers", F.coalesce(F.sum(F.col("fits").cast("int")).over(following), F.lit(0)))
        .where(F.col("fits") & (F.col("block") == F.col("own")))
    )
    best = F.max_by("row_number", F.struct("hints", "followers", "letters", -F.col("row_number")))
    return candidates.groupBy("path", "delimiter", "width", "last_row").agg(best.alias("header_row"))


def unique_headers(headers: DataFrame) -> DataFrame:
    """Header cells (path, cells) to unique names: path, position, header.

    A blank cell is named by its position; the k-th use of a name gets the suffix ``_k``.
    """
    cells = headers.select("path", F.posexplode("cells").alias("position", "raw"))
    return name_columns(cells.withColumn("position", F.col("position") + 1))


def header_names(records: DataFrame, headers: DataFrame) -> DataFrame:
    """The unique names of the columns of every file: path, position, header."""
    rows = headers.select("path", "delimiter", F.col("header_row").alias("row_number"))
    return unique_headers(records.join(rows, ["path", "delimiter", "row_number"]).select("path", "cells"))


def name_columns(cells: DataFrame) -> DataFrame:
    """S16 on one row per header cell (path, position from 1, raw)."""
    named = cells.select("path", "position", strip("raw").alias("raw"))
    clean = F.when(F.col("raw") == "", F.concat(F.lit("unnamed_column_"), F.col("position").cast("string"))).otherwise(F.col("raw"))
    # A window per file and name over the cells of one record, which is one row in size.
    use = F.row_number().over(Window.partitionBy("path", "clean").orderBy("position"))
    suffix = F.when(F.col("use") > 1, F.concat(F.lit("_"), F.col("use").cast("string"))).otherwise("")
    return named.withColumn("clean", clean).withColumn("use", use).select(
        "path", "position", F.concat("clean", suffix).alias("header")
    )


def table_rows(records: DataFrame, headers: DataFrame) -> DataFrame:
    """Non-blank rows below the header; ``fits`` tells table rows from skipped ones."""
    return (
        join_file_facts(records, headers, ["path", "delimiter"], "row_number", "last_row")
        .where((F.col("row_number") > F.col("header_row")) & _filled())
        .select("path", "row_number", "cells", (F.size("cells") == F.col("width")).alias("fits"))
    )


def resolve_columns(headers: DataFrame) -> DataFrame:
    """Per file a map from employee attribute to source column, null where none matches.

    ``headers`` has path, position, header. Of columns with one normalised name the last counts; of
    the aliases of an attribute the first present one.
    """
    aliases = F.create_map(*[
        F.lit(x) for canonical, names in COLUMN_ALIASES.items() for rank, name in enumerate(names)
        for x in (name, f"{rank:02d}|{canonical}")
    ])
    matched = headers.withColumn("alias", F.try_element_at(aliases, normalise_header("header")))
    canonical, rank = F.substring_index("alias", "|", -1), F.substring_index("alias", "|", 1)
    return matched.groupBy("path").agg(*[
        F.max_by(
            F.when(canonical == name, F.col("header")),
            F.when(canonical == name, F.struct(-rank.cast("int"), F.col("position"))),
        ).alias(name)
        for name in COLUMN_ALIASES
    ])


def profile_records(layout: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file: layout, row counts, columns, attributes, and an error where none fits."""
    headers = land(find_headers(records, layout), "headers")
    names = header_names(records, headers)
    listed = names.groupBy("path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "header"))), lambda s: s["header"]).alias("columns")
    )
    counts = table_rows(records, headers).groupBy("path").agg(
        F.count_if("fits").alias("table_rows"), F.count_if(~F.col("fits")).alias("skipped_rows")
    )
    profile = (
        files.select("path", "file_name", "encoding", F.col("error").alias("file_error"))
        .join(headers.drop("last_row"), "path", "left")
        .join(listed, "path", "left")
        .join(counts, "path", "left")
        .join(resolve_columns(names), "path", "left")
    )
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in REQUIRED_COLUMNS])
    error = F.coalesce("file_error", F.when(F.col("header_row").isNull(), F.lit("NO_TABLE")))
    return profile.select(
        "path", "file_name", "encoding", "delimiter", F.col("header_row").alias("header_row_number"),
        F.col("width").alias("table_width"),
        F.when(F.col("header_row").isNotNull(), F.coalesce("table_rows", F.lit(0))).alias("table_rows"),
        F.when(F.col("header_row").isNotNull(), F.coalesce("skipped_rows", F.lit(0))).alias("skipped_rows"),
        "columns", *COLUMN_ALIASES, complete.alias("complete_candidate"), error.alias("error"),
    )


def profile_folder(spark: SparkSession, directory: str) -> DataFrame:
    """S19 over all CSV files of a folder; no file is an error."""
    files, lines = read_files(spark, directory, "*.csv")
    return profile_records(*read_layout(lines), files)


def candidate_files(profile: DataFrame) -> DataFrame:
    """Names of the files that carry every required employee column."""
    return profile.where("complete_candidate").select("file_name").orderBy("file_name")


def inventory(records: DataFrame, files: DataFrame) -> DataFrame:
    """Per file the row and column counts, column names, column types and the first five rows.

    The first record is the header. A column is a whole number, a number, a truth value or text,
    judged over all its non-empty cells; an empty column counts as a number.
    """
    filled = records.where(F.size("cells") > 0)
    first = filled.groupBy("path").agg(F.min("row_number").alias("header_row"), F.max("row_number").alias("last_row"))
    placed = join_file_facts(filled, first, ["path"], "row_number", "last_row")
    header = placed.where("row_number = header_row").select("path", F.col("cells").alias("columns"))
    body = placed.where("row_number > header_row")

    cells = body.select("path", F.posexplode("cells").alias("position", "cell")).where("cell <> ''")
    kind = (
        F.when(F.bool_and(F.col("cell").rlike(r"^\s*[+-]?[0-9]+\s*\z")), "int64")
        .when(F.bool_and(F.col("cell").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z")), "float64")
        .when(F.bool_and(F.col("cell").isin("True", "False", "TRUE", "FALSE", "true", "false")), "bool")
        .otherwise("object")
    )
    types = cells.groupBy("path", "position").agg(kind.alias("kind"), F.count(F.lit(1)).alias("filled"))
    counts = body.groupBy("path").agg(F.count(F.lit(1)).alias("row_count"))
    # pandas widens a whole-number column with gaps to float.
    widened = types.join(counts, "path").select(
        "path", "position",
        F.when((F.col("kind") == "int64") & (F.col("filled") < F.col("row_count")), "float64")
        .when((F.col("kind") == "bool") & (F.col("filled") < F.col("row_count")), "object")
        .otherwise(F.col("kind")).alias("kind"),
    )
    by_position = widened.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("position", "kind"))).alias("kinds"))
    # Spark keeps the first five per file in every task before it shuffles (window group limit).
    ranked = body.withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy("row_number"))).where("n <= 5")
    head = ranked.groupBy("path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("n", "cells"))), lambda s: s["cells"]).alias("first_rows")
    )
    kinds = F.transform(
        "columns", lambda _, i: F.coalesce(F.try_element_at("kinds", i), F.lit("float64"))
    )
    return (
        files.select("path", "file_name", "error")
        .join(header, "path", "left")
        .join(counts, "path", "left")
        .join(by_position, "path", "left")
        .join(head, "path", "left")
        .select(
            "path", "file_name", F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.size("columns").alias("column_count"), "columns", kinds.alias("column_types"), "first_rows", "error",
        )
    )
