"""Lines to delimited records (S6): path, row_number, cells.

Quoting follows the usual reader rules: a quote opens a field only at its start, a doubled quote is
one quote, text after the closing quote is kept, and a quoted field may run over several lines.
Everything is a column expression; no Python runs per row.

Where a record ends depends on all lines before it, but only through one bit: is a quoted field
open? A line maps that bit at its start to the bit at its end, and such maps compose. A file in
which no line leaves a field open has one record per line. Only other files take the scan, which
composes the maps of blocks of lines first and then the lines within a block.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.text import strip
from rollcall.storage import land

BLOCK_LINES = 10_000

_QUOTED = '"[^"]*+(?:""[^"]*+)*+'


def _with(pattern: str, delimiter: Column) -> Column:
    """The pattern with ``~`` standing for the delimiter."""
    parts = pattern.split("~")
    joined = [F.lit(parts[0])]
    for part in parts[1:]:
        joined += [delimiter, F.lit(part)]
    return F.concat(*joined)


def _by_pattern(delimiter: Column, make: Callable[[Column], Column]) -> Column:
    """``make(delimiter)``, with the usual delimiters as literals: a pattern out of a column is compiled again wherever the file changes."""
    usual = [(delimiter == letter, make(F.lit(letter))) for letter in (",", ";", "\t", "|")]
    return reduce(lambda found, one: found.when(*one), usual[1:], F.when(*usual[0])).otherwise(make(delimiter))


def _inner(record: Column) -> Column:
    """What a record of at least two characters, the first and last of them quotes, has between them: by bytes, so that no letters are counted."""
    return F.substring(record.cast("binary"), F.lit(2), F.octet_length(record) - 2).cast("string")


def _ended(line: Column) -> Column:
    """The line without the carriage returns at its end. There is one at most in nearly every line, and it is cut off as a byte."""
    cut = F.substring(line.cast("binary"), F.lit(1), F.octet_length(line) - 1).cast("string")
    return F.when(~line.endswith("\r"), line).when(~cut.endswith("\r"), cut).otherwise(F.rtrim(line, F.lit("\r")))


def _between(delimiter: Column) -> Column:
    return F.concat(F.lit('"'), delimiter, F.lit('"'))


def all_quoted(record: Column, delimiter: Column) -> Column:
    """Nothing but quoted fields without a quote in them: what stands between the fields shows by itself, without a pattern."""
    framed = record.startswith('"') & record.endswith('"') & (F.octet_length(record) >= 2)
    return framed & ~F.contains(F.replace(_inner(record), _between(delimiter), F.lit("")), F.lit('"'))


def split_cells(record: Column, delimiter: Column) -> Column:
    """Cells of one record; an empty record has none."""
    # Few records have a zero letter. translate goes through a map, letter by letter.
    record = F.when(F.contains(record, F.lit("\u0000")), F.replace(record, F.lit("\u0000"), F.lit(""))).otherwise(record)
    fields = _by_pattern(delimiter, lambda d: F.regexp_extract_all(F.concat(d, record), _with(f'(?s)[~]({_QUOTED}"[^~]*+|{_QUOTED}\\z|[^~]*+)', d), F.lit(1)))

    def general(field: Column) -> Column:
        inner = F.regexp_replace(F.regexp_extract(field, f"(?s)^({_QUOTED})", 1), '^"', "")
        rest = F.regexp_extract(field, f'(?s)^{_QUOTED}"(.*)\\z', 1)
        return F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)

    def unquoted(field: Column) -> Column:
        return (
            F.when(~field.startswith('"'), field)
            .when(field.endswith('"') & (F.octet_length(field) >= 2) & ~F.contains(_inner(field), F.lit('"')), _inner(field))
            .otherwise(general(field))
        )

    # These letters, one of them behind a backslash, are split at without a pattern.
    plain = F.split(record, F.when(delimiter.isin(",", ";", "\t"), delimiter).when(delimiter == "|", F.lit("\\|")).otherwise(F.concat(F.lit("["), delimiter, F.lit("]"))))
    # The record has no zero letter any more, and a single letter is split at without a pattern.
    inner = F.split(F.replace(_inner(record), _between(delimiter), F.lit("\u0000")), "\u0000")
    cells = F.when(~F.contains(record, F.lit('"')), plain).when(all_quoted(record, delimiter), inner).otherwise(F.transform(fields, unquoted))
    return F.when(record == "", F.array().cast("array<string>")).otherwise(cells)


def leaves_open(line: Column, delimiter: Column, inside: bool = False) -> Column:
    """Is a quoted field open at the end of the line, given whether one was at its start?"""
    start = lambda d: F.concat(d, F.lit('"') if inside else F.lit(""), line)
    pattern = f'(?s)^(?:[~](?:{_QUOTED}"|(?!"))[^~]*+)*+[~]{_QUOTED}\\z'
    found = F.when(F.contains(line, F.lit('"')), _by_pattern(delimiter, lambda d: F.rlike(start(d), _with(pattern, d)))).otherwise(F.lit(inside))
    if inside:
        return found
    # Only a quote at the start of a field opens it, and a line of closed fields that are all quoted leaves none open.
    may_open = line.startswith('"') | F.contains(line, F.concat(delimiter, F.lit('"')))
    return F.when(may_open & ~all_quoted(_ended(line), delimiter), found).otherwise(F.lit(False))


def cell_counts(lines: DataFrame, delimiters: tuple[str, ...]) -> DataFrame:
    """Each line as a record under each of several delimiters, in one pass: the columns of ``lines`` but ``line``, and
    delimiter, width (number of cells), filled (whether any cell has a visible character) and opens (whether a field is left open).

    Cells are made only of lines with a quote; elsewhere counting characters tells as much.
    """
    others = [c for c in lines.columns if c not in ("line", "delimiter")]
    record = F.replace(F.regexp_replace("line", "\r+\\z", ""), F.lit("\u0000"), F.lit(""))
    quoted = F.contains(F.col("record"), F.lit('"'))
    cut = lines.select(*others, "line", record.alias("record")).select(
        *others, "line", "record", *(F.when(quoted, split_cells(F.col("record"), F.lit(d))).alias(f"_cells{i}") for i, d in enumerate(delimiters))
    )

    def reading(delimiter: str, cells: str) -> Column:
        bare = F.replace("record", F.lit(delimiter))
        width = F.when(F.col("record") == "", 0).when(F.col(cells).isNull(), F.length("record") - F.length(bare) + 1).otherwise(F.size(cells))
        filled = F.when(F.col(cells).isNull(), strip(bare) != "").otherwise(F.exists(cells, lambda cell: strip(cell) != ""))
        opens = leaves_open(F.col("line"), F.lit(delimiter))
        return F.struct(F.lit(delimiter).alias("delimiter"), width.alias("width"), filled.alias("filled"), opens.alias("opens"))

    return cut.select(*others, F.inline(F.array(*(reading(d, f"_cells{i}") for i, d in enumerate(delimiters)))))


def _entry_state(df: DataFrame, groups: list[str], order: str) -> DataFrame:
    """Per row: ``_fixed`` (the bit set by the rows before, or null) and ``_odd`` (flips since then).

    Rows carry ``_from0`` and ``_from1``, the bit after the row when it was 0 or 1 before.
    """
    before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = (F.col("_from0") & ~F.col("_from1")).cast("bigint")
    counted = df.withColumn("_flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    constant = F.col("_from0") == F.col("_from1")
    reset = F.last(F.when(constant, F.struct(F.col("_from0").alias("bit"), F.col("_flips").alias("at"))), True).over(before)
    return (
        counted.withColumn("_reset", reset)
        .withColumn("_fixed", F.col("_reset.bit"))
        .withColumn("_odd", (F.col("_flips") - F.coalesce("_reset.at", F.lit(0))) % 2 == 1)
    )


def _bit(entry: Column) -> Column:
    """The bit before a row whose group starts with ``entry``."""
    start = F.coalesce("_fixed", entry)
    return F.when(F.col("_odd"), ~start).otherwise(start)


def number_records(lines: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Lines with the number of the record they belong to (``row_number``), for any quoting.

    ``unclosed`` marks the lines from a quote on that is open at the end of the file.
    """
    mapped = (
        lines.withColumn("_from0", leaves_open(F.col("line"), F.col("delimiter")))
        .withColumn("_from1", leaves_open(F.col("line"), F.col("delimiter"), inside=True))
        .withColumn("_block", F.floor((F.col("line_number") - 1) / block_lines))
    )
    inside = _entry_state(mapped, ["path", "_block"], "line_number")
    after = F.struct(
        F.when(_bit(F.lit(False)), F.col("_from1")).otherwise(F.col("_from0")).alias("from0"),
        F.when(_bit(F.lit(True)), F.col("_from1")).otherwise(F.col("_from0")).alias("from1"),
    )
    blocks = inside.groupBy("path", "_block").agg(F.max_by(after, "line_number").alias("_after")).select(
        "path", "_block", F.col("_after.from0").alias("_from0"), F.col("_after.from1").alias("_from1")
    )
    entries = _entry_state(blocks, ["path"], "_block").select("path", "_block", _bit(F.lit(False)).alias("_entry"))
    closed = (
        inside.join(entries, ["path", "_block"])
        .withColumn("_open", _bit(F.col("_entry")))
        .withColumn("_closes", ~F.when(F.col("_open"), F.col("_from1")).otherwise(F.col("_from0")))
    )
    ended = closed.groupBy("path", "_block").agg(F.count_if("_closes").alias("_ended"))
    earlier_blocks = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ended.select(
        "path", "_block", F.coalesce(F.sum("_ended").over(earlier_blocks), F.lit(0)).alias("_before"),
        F.sum("_ended").over(Window.partitionBy("path")).alias("_all"),
    )
    earlier_lines = Window.partitionBy("path", "_block").orderBy("line_number").rowsBetween(Window.unboundedPreceding, -1)
    inside_count = F.coalesce(F.sum(F.col("_closes").cast("bigint")).over(earlier_lines), F.lit(0))
    return (
        closed.withColumn("_inside", inside_count)
        .join(offsets, ["path", "_block"])
        .withColumn("row_number", F.col("_before") + F.col("_inside") + 1)
        .withColumn("unclosed", F.col("row_number") > F.col("_all"))
        .select(*lines.columns, "row_number", "unclosed")
    )


def read_records(lines: DataFrame, extra: list[str] | None = None, spanning: DataFrame | None = None) -> DataFrame:
    """Records of all files: path, row_number, cells and ``unclosed`` for a quote that is never closed.

    ``extra`` names further columns that identify a file reading, such as the delimiter when one
    file is read with several. Files with a record over several lines are looked for first, as
    only they need the scan; there is one row per such file, and usually none. A caller that knows them gives them as ``spanning``.
    """
    group = ["path", *(extra or [])]
    carried = group if "delimiter" in group else [*group, "delimiter"]
    if spanning is None:
        opens = F.contains("line", F.lit('"')) & leaves_open(F.col("line"), F.col("delimiter"))
        spanning = land(lines.where(opens).select(*group).distinct(), "spanning")
    if spanning.isEmpty():
        return _cut(_one_per_line(lines, carried), carried)
    single = _one_per_line(lines.join(spanning, group, "left_anti"), carried)
    many = _over_lines(lines.join(spanning, group, "left_semi"), group, carried)
    return _cut(single.unionByName(many), carried)


def _one_per_line(lines: DataFrame, carried: list[str]) -> DataFrame:
    return lines.select(
        *carried, F.col("line_number").alias("row_number"), _ended(F.col("line")).alias("record"), F.lit(False).alias("unclosed")
    )


def one_per_line(lines: DataFrame, carried: list[str], opens: Column) -> DataFrame:
    """The records of files in which each line is one, with ``opens``."""
    rows = lines.select(*carried, F.col("line_number").alias("row_number"), _ended(F.col("line")).alias("record"), opens.alias("opens"))
    return rows.select(*carried, "row_number", _cells().alias("cells"), "opens")


def _over_lines(lines: DataFrame, group: list[str], carried: list[str]) -> DataFrame:
    """Records of files in which some run over several lines."""
    reading = lines.withColumn("_path", F.col("path")).withColumn("path", F.concat_ws("\u0001", *group))
    numbered = land(number_records(land(reading, "spanning_lines")).withColumn("path", F.col("_path")), "numbered_lines")
    # A quote that is never closed would make the rest of the file one record: only its first line is kept, as a mark.
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_number", "line"))), lambda p: p["line"]), "\n")
    closed = numbered.where(~F.col("unclosed")).groupBy(*carried, "row_number").agg(F.regexp_replace(whole, "\r+\\z", "").alias("record"))
    left_open = numbered.where("unclosed").groupBy(*carried).agg(F.min("row_number").alias("row_number"))
    return closed.withColumn("unclosed", F.lit(False)).unionByName(
        left_open.select(*carried, "row_number", F.lit(None).cast("string").alias("record"), F.lit(True).alias("unclosed"))
    )


def _cells() -> Column:
    return F.coalesce(split_cells(F.col("record"), F.col("delimiter")), F.array().cast("array<string>"))


def _cut(records: DataFrame, carried: list[str]) -> DataFrame:
    return records.withColumn("cells", _cells()).select(*carried, "row_number", "cells", "unclosed")
