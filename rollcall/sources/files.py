"""Input files to decoded lines.

``lines`` have the columns path, line_number, line, delimiter: text without its line feed.
``files`` have one row per file: path, file_name, length, source_file_hash, encoding, delimiter, error.

Files of every size go one way: they are read as byte lines by many tasks, and what holds for the
file as a whole (line numbers, encoding, delimiter, content hash) is aggregated and joined back by file
and block of lines. Everything is a column expression.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.functions.text import col, is_ascii, may_name, without_zeros
from rollcall.sources.perfile import BLOCK_LINES, LINE_BLOCK, join_dealt, join_file_facts, line_block
from rollcall.sources.records import leaves_open, one_per_line, read_records
from rollcall.storage import land, land_dealt

# Accepted extensions, delimiters to choose from when there is no tab.
EXTENSIONS = (".csv", ".xlsx", ".xls")
CHOSEN_FROM = (";", "|", ",")

# Lines and bytes in a bucket of dealt lines.
DEAL_LINES, DEAL_BYTES = 150_000, 16_000_000


def plain_name(name) -> Column:
    """A file name or path that Spark gives in URL form."""
    return F.url_decode(F.replace(col(name), F.lit("+"), F.lit("%2B")))


def _file_name() -> Column:
    return plain_name("_metadata.file_name")


def exact(paths: list[str]) -> list[str]:
    """Paths in which no character is read as a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]


def binary_files(spark: SparkSession, directory: str | list[str], glob: str) -> DataFrame:
    """The files of a folder, or single files, as rows; their content is only read where it is selected."""
    places = directory if isinstance(directory, str) else exact(directory)
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(places)


def _listing(spark: SparkSession, directory: str | list[str], glob: str) -> DataFrame:
    return binary_files(spark, directory, glob).select(
        F.col("_metadata.file_path").alias("path"), _file_name().alias("file_name"),
        "length", "content", F.col("path").alias("location"),
    )


def empty_files(spark: SparkSession, directory: str | list[str], glob: str) -> DataFrame:
    """Files of zero bytes (path, file_name, length), which Spark leaves out of every scan.

    The names come from the file index, which the driver holds for any read of the folder.
    """
    indexed = binary_files(spark, directory, glob).inputFiles()
    names = spark.createDataFrame([(name,) for name in indexed], "path string")
    path = F.regexp_replace("path", "^file:/+", "file:/")
    file_name = plain_name(F.substring_index(path, "/", -1))
    return (
        names.select(path.alias("path"), file_name.alias("file_name"), F.lit(0).cast("bigint").alias("length"))
        .join(_listing(spark, directory, glob).select("path"), "path", "left_anti")
    )


def find_input_files(spark: SparkSession, directory: str, extensions=EXTENSIONS) -> DataFrame:
    """Files by extension in any case, sorted by name. A missing folder gives no rows."""
    pattern = r"(?i)(" + "|".join(e.replace(".", r"\.") for e in extensions) + r")\z"
    try:
        files = _listing(spark, directory, "*")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "path string, file_name string, length bigint")
    found = files.drop("content", "location").unionByName(empty_files(spark, directory, "*"))
    return found.where(F.col("file_name").rlike(pattern)).orderBy("file_name", "path")


def require_files(spark: SparkSession, directory: str | list[str], glob: str) -> None:
    """Stop when no file matches, as the meeting loader and the profiler do. One name is enough to know; empty files are only looked for without one."""
    if binary_files(spark, directory, glob).select("path").isEmpty() and empty_files(spark, directory, glob).isEmpty():
        raise FileNotFoundError(f"no {glob} files found in {directory}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A plain delimited file with a header and inferred types."""
    if PurePosixPath(path).suffix.lower() != ".csv":
        raise ValueError(f"unsupported file type: {PurePosixPath(path).suffix}")
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


# --- decoding -------------------------------------------------------------------------------

# Bytes 0x80-0x9F of windows-1252, seen through ISO-8859-1; five of them are undefined.
_HIGH = [bytes([b]) for b in range(0x80, 0xA0)]
_DEFINED = [b for b in _HIGH if b.decode("cp1252", "ignore")]
_LATIN = "".join(b.decode("latin-1") for b in _DEFINED)
_CP1252 = "".join(b.decode("cp1252") for b in _DEFINED)
_HIGH_LETTERS = "[\u0080-\u009f]"
_UNDEFINED = "[" + "".join(b.decode("latin-1") for b in _HIGH if b not in _DEFINED) + "]"


def _latin1(content: Column) -> Column:
    return F.decode(content, "ISO-8859-1")


def is_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))


def has_undefined_byte(content: Column, ascii_only: Column | None = None) -> Column:
    return F.when(is_ascii(content) if ascii_only is None else ascii_only, False).otherwise(_latin1(content).rlike(_UNDEFINED))


def bom(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2))


def choose_encoding(utf8: Column, mark: Column, even: Column, undefined: Column) -> Column:
    """S3: UTF-8 (a mark is dropped), UTF-16 when marked, windows-1252, else ISO-8859-1."""
    return (
        F.when(utf8, "utf-8-sig")
        .when((mark == "FFFE") & even, "utf-16-le")
        .when((mark == "FEFF") & even, "utf-16-be")
        .when(~undefined, "cp1252")
        .otherwise("latin1")
    )


def decode(content: Column, encoding: Column, ascii_only: Column | None = None) -> Column:
    """Text of whole lines; UTF-16 has to be well formed (see ``is_well_formed``)."""
    ascii_only = is_ascii(content) if ascii_only is None else ascii_only
    return (
        F.when((encoding == "utf-8-sig") | (~encoding.startswith("utf-16") & ascii_only), content.cast("string"))
        .when(encoding == "utf-16-le", F.decode(F.when(encoding == "utf-16-le", content), "UTF-16LE"))
        .when(encoding == "utf-16-be", F.decode(F.when(encoding == "utf-16-be", content), "UTF-16BE"))
        .when((encoding == "cp1252") & _latin1(content).rlike(_HIGH_LETTERS), F.translate(_latin1(content), _LATIN, _CP1252))
        .otherwise(_latin1(content))
    )


def is_well_formed(content: Column, wide: Column, ascii_only: Column | None = None) -> Column:
    """Whether UTF-16 bytes have every surrogate in a pair, seen through ISO-8859-1."""
    ascii_only = is_ascii(content) if ascii_only is None else ascii_only
    low_first = r"(?s)\A(?:.[^Ø-ß]|.[Ø-Û].[Ü-ß])*+\z"
    high_first = r"(?s)\A(?:[^Ø-ß].|[Ø-Û].[Ü-ß].)*+\z"
    text = _latin1(content)
    # Without a byte of a surrogate only the number of bytes counts.
    plain = (F.length(content) % 2 == 0) & ascii_only
    return F.when(wide.isNull() | plain, True).when(wide == "FFFE", text.rlike(low_first)).when(wide == "FEFF", text.rlike(high_first)).otherwise(True)


def _decoded_wide(content: Column, wide: Column, formed: Column) -> Column:
    """The text of a well-formed line in UTF-16, null for others."""
    return F.when(wide == "FFFE", F.decode(F.when((wide == "FFFE") & formed, content), "UTF-16LE")).when(
        wide == "FEFF", F.decode(F.when((wide == "FEFF") & formed, content), "UTF-16BE")
    )


def _plain_text(content: Column, wide: Column, formed: Column, decoded: Column, plain: Column) -> Column:
    """The characters of a line up to U+00FF, enough to look for delimiters before it is decoded."""
    text = _latin1(content)
    return (
        F.when(wide.isNull(), F.when(plain, content.cast("string")).otherwise(text))
        .when(formed, F.when(plain, decoded).otherwise(F.regexp_replace(decoded, "[^\u0000-\u00ff]+", "")))
        .when(wide == "FFFE", F.regexp_replace(text, r"(?s)(.)\x00|..", "$1"))
        .otherwise(F.regexp_replace(text, r"(?s)\x00(.)|..", "$1"))
    )


def _with_text(raw: DataFrame) -> DataFrame:
    """Lines with ``ascii``, ``well_formed``, ``decoded`` (UTF-16 only), ``text`` and whether it is ``plain`` (all ASCII), each in a step of its own, as several facts are taken from them.

    The first two are not made again where lines were landed with them.
    """
    content, wide, formed, ascii_only, decoded = (F.col(name) for name in ("raw", "wide", "well_formed", "ascii", "decoded"))
    rows = raw if "ascii" in raw.columns else raw.withColumn("ascii", is_ascii(content))
    rows = rows if "well_formed" in raw.columns else rows.withColumn("well_formed", is_well_formed(content, wide, ascii_only))
    rows = rows.withColumn("decoded", _decoded_wide(content, wide, formed))
    # A character of UTF-16 has two bytes, and as UTF-8 one if it is ASCII; others have as many or more.
    plain = F.when(wide.isNull(), ascii_only).otherwise(F.coalesce(F.octet_length(decoded) * 2 == F.octet_length(content), F.lit(False)))
    rows = rows.withColumn("plain", plain)
    return rows.withColumn("text", _plain_text(content, wide, formed, decoded, F.col("plain")))


#: What is asked of a line by itself, and whether it may hold a label. It is landed with the line, so that later steps need not look at its text for it.
LINE_FACTS = ("ascii", "utf8", "undefined", "well_formed", "tab", "open", "bare_cr", "quoted")
NAMED = "named"


def with_line_facts(raw: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """``whole_lines`` with their ``LINE_FACTS`` and, where ``words`` of labels are given, with ``named``. The text of a line is made once for all of them."""
    bare = raw.drop(*LINE_FACTS, NAMED)
    content, ascii_only, text = F.col("raw"), F.col("ascii"), F.col("text")
    # All but the last byte; the last character, if it has several, is none that is looked for.
    ahead = F.substring(text.cast("binary"), F.lit(1), F.octet_length(text) - 1).cast("string")
    facts = {
        "ascii": ascii_only, "utf8": F.when(ascii_only, True).otherwise(is_utf8(content)), "undefined": has_undefined_byte(content, ascii_only),
        "well_formed": F.col("well_formed"), "tab": F.contains(text, F.lit("\t")), "open": _holds(text, ";|"),
        # A carriage return that is not the last character.
        "bare_cr": F.contains(ahead, F.lit("\r")), "quoted": F.contains(text, F.lit('"')),
    }
    rows = _with_text(bare)
    if words:
        rows = rows.withColumn("_seen", without_zeros(F.coalesce("decoded", "text"))).withColumn("_letters", F.lower("_seen"))
        facts[NAMED] = may_name(F.col("_seen"), F.col("_letters"), F.col("plain"), F.col("decoded").isNotNull(), words)
    return rows.select(*bare.columns, *(value.alias(name) for name, value in facts.items()))


def file_error(length: Column, undecodable: Column) -> Column:
    return F.when(length == 0, "EMPTY_FILE").when(undecodable, "UNDECODABLE")


FILE_COLUMNS = ["path", "file_name", "length", "source_file_hash", "encoding", "delimiter", "error"]
LINE_COLUMNS = ["path", "line_number", "line", "delimiter"]


# --- byte lines -----------------------------------------------------------------------------


def read_byte_lines(spark: SparkSession, directory: str | list[str], glob: str) -> DataFrame:
    """Lines of files as bytes (path, file_name, length, line_number, raw), each file read by many tasks.

    A task knows the order of its own lines only. Lines are counted per block of a file, and the
    count of the earlier blocks is added.
    """
    places = directory if isinstance(directory, str) else exact(directory)
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(places).select(
        F.col("_metadata.file_path").alias("path"), _file_name().alias("file_name"),
        F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("raw"),
    )
    blocks = read.groupBy("path", "block").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "block", "first_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return read.join(offsets, ["path", "block"]).select(
        "path", "file_name", "length", (F.col("before") + F.col("id") - F.col("first_id") + 1).alias("line_number"), "raw"
    )


def _running(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all earlier lines of the file, added up block by block."""
    placed = rows.withColumn("_at", F.floor(F.col("line_number") / BLOCK_LINES)).withColumn("_value", value.cast("bigint"))
    earlier = Window.partitionBy("path").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("path", "_at").agg(F.sum("_value").alias("_sum"))
    offsets = blocks.select("path", "_at", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("path", "_at").orderBy("line_number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, ["path", "_at"])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_at", "_value", "_inside", "_before")
    )


def dealt_lines(raw: DataFrame, parts: int, name: str = "byte_lines") -> DataFrame:
    """Lines (path, line_number) landed in buckets by file and block of lines."""
    placed = raw if LINE_BLOCK in raw.columns else raw.withColumn(LINE_BLOCK, line_block(F.col("line_number")))
    return land_dealt(placed, name, ["path", LINE_BLOCK], parts)


def _pieces(raw: DataFrame, *more: str) -> DataFrame:
    return raw.select("path", "line_number", "raw", *(c for c in raw.columns if c == LINE_BLOCK or c in more))


def whole_lines(raw: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Byte lines with ``wide`` (the mark of a UTF-16 file, else null) and with the lines of such files mended.

    In UTF-16 a line feed has two bytes, and its byte may be half of another character. In nearly every file it never
    is, and that shows in each piece between two such bytes by itself: a real line feed leaves its zero byte to one of
    its neighbours, whose length is odd then. Such files keep their pieces, without that byte. Only in
    others the place of each piece in the file is needed. ``sizes`` (path, file_name, length) are given if they are not
    in ``raw``. All lines meet the facts of their file once.
    """
    size, first = F.length("raw"), F.col("line_number") == 1
    mark, odd = bom(F.col("raw")), size % 2 == 1
    leads, trails = F.hex(F.substring("raw", 1, 1)) == "00", F.hex(F.substring("raw", -1, 1)) == "00"
    shapes = raw.groupBy(*(["path"] if sizes is not None else ["path", "file_name", "length"])).agg(
        F.max(F.when(first & (mark == "FFFE"), 1).when(first & (mark == "FEFF"), 2)).alias("order"), F.max("line_number").alias("last_piece"),
        F.count_if(F.when(first, odd).otherwise(~odd | ~leads)).alias("odd_little"), F.count_if(~odd | ~trails).alias("odd_big"),
        F.max_by(odd, "line_number").alias("ends_odd"),
    )
    if sizes is not None:
        shapes = shapes.join(sizes, "path")
    # Big endian: the last piece, if no line feed follows it, has no such byte.
    little = F.col("wide") == "FFFE"
    plain = F.when(little, F.col("odd_little") == 0).otherwise(F.col("odd_big") == F.when(F.col("ends_odd"), 0).otherwise(1))
    wide = F.when((F.col("length") % 2 == 0) & (F.col("order") == 1), "FFFE").when((F.col("length") % 2 == 0) & (F.col("order") == 2), "FEFF")
    shapes = shapes.withColumn("wide", wide).withColumn("plain", F.col("wide").isNull() | plain)
    shapes = land(shapes.select("path", "file_name", "length", "last_piece", "wide", "plain"), "shapes")
    if sizes is None and shapes.where("wide IS NOT NULL").isEmpty():
        return raw.withColumn("wide", F.lit(None).cast("string"))
    pieces = _pieces(raw)
    easy = join_dealt(pieces, shapes.where("plain").drop("plain"), "line_number", "last_piece")
    last = F.col("line_number") == F.col("last_piece")
    content = (
        F.when(little & ~first, F.substring(F.col("raw"), F.lit(2), size)).when((F.col("wide") == "FEFF") & odd, F.substring(F.col("raw"), F.lit(1), size - 1)).otherwise(F.col("raw"))
    )
    # The second byte of the last line feed of a little endian file is no line.
    remnant = F.coalesce(little, F.lit(False)) & last & ~first & (size == 1)
    blocked = [c for c in raw.columns if c == LINE_BLOCK]
    kept = easy.where(~remnant).withColumn("raw", content).select("path", "file_name", "length", "line_number", "raw", "wide", *blocked)
    hard = shapes.where("NOT plain").select("path", "file_name", "wide", "length", "last_piece")
    if hard.isEmpty():
        return kept
    mended = _mended(join_dealt(pieces, hard, "line_number", "last_piece").drop("last_piece", LINE_BLOCK))
    return kept.unionByName(mended.withColumn(LINE_BLOCK, line_block(F.col("line_number"))) if blocked else mended)


def _mended(pieces: DataFrame) -> DataFrame:
    """The lines of UTF-16 files in which the byte of a line feed is also half of another character.

    Bytes between two such bytes are one line unless both lie where a character begins and ends: that follows
    from the place of the byte in the file, which is the sum of the lengths before it.
    """
    placed = _running(pieces, F.length("raw") + 1, "start")
    little, size = F.col("wide") == "FFFE", F.length("raw")
    first, last = F.hex(F.substring("raw", 1, 1)) == "00", F.hex(F.substring("raw", -1, 1)) == "00"
    begins = (F.col("line_number") == 1) | ((F.col("start") % 2 == 1) & first)
    ends = ((F.col("start") + size) % 2 == 1) & last
    # Little endian: the zero byte behind a real line feed begins a line. Big endian: the one before it ends a line.
    stepped = placed.withColumn("step", F.when(little, begins).otherwise(ends))
    numbered = _running(stepped, F.col("step"), "prior").withColumn(
        "number", F.col("prior") + F.when(little, F.col("step").cast("bigint")).otherwise(F.lit(1))
    )
    half = F.col("step") & (~little | (F.col("line_number") > 1))
    content = (
        F.when(half & little, F.substring(F.col("raw"), F.lit(2), size))
        .when(half, F.substring(F.col("raw"), F.lit(1), size - 1)).otherwise(F.col("raw"))
    )
    remnant = little & half & (size == 1) & (F.col("start") + 1 == F.col("length"))
    # The reader takes the last byte of the file for a line feed; it may be half of the last character.
    lost = (F.col("start") + size + 1 == F.col("length")) & (little | ~F.col("step"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_number", "piece"))), lambda p: p["piece"]), "\n")
    mended = (
        numbered.where(~remnant).withColumn("piece", F.concat(_latin1(content), F.when(lost, "\n").otherwise("")))
        .groupBy("path", "file_name", "length", "wide", "number").agg(F.encode(joined, "ISO-8859-1").alias("raw"))
    )
    return mended.withColumnRenamed("number", "line_number").select("path", "file_name", "length", "line_number", "raw", "wide")


#: How facts about parts of a file become facts about the whole.
_TOGETHER = {
    "last_line": F.max, "mark": F.max, "utf8": F.bool_and, "undefined": F.bool_or, "well_formed": F.bool_and, "tab": F.bool_or, "open": F.bool_or,
    "bare_cr": F.bool_or,
}


def _folded(position: str, as_hex: bool = False) -> Column:
    """The digest of the digests of a part, in the order of ``position``. Digests travel as bytes and are joined as hex digits, which they may be already."""
    # Not array_sort, which compares through an expression.
    parts = F.sort_array(F.collect_list(F.struct(position, "digest")))
    joined = F.array_join(parts["digest"], "") if as_hex else F.lower(F.array_join(F.transform(parts, lambda p: F.hex(p["digest"])), ""))
    return F.unhex(F.sha2(joined, 256))


def describe_byte_lines(raw: DataFrame, fan: int | None = None) -> DataFrame:
    """One row per file out of its ``whole_lines``: the ``files`` columns, ``last_line`` and ``bare_cr``.

    The content hash (S12) is the root of a tree: the SHA-256 of each numbered line, of the digests of each block of
    ``fan`` lines, of each ``fan`` blocks, and of all these with the length of the file. It is one definition for all
    sizes, no task holds more than ``fan`` digests but for the last step, and only files with the same bytes share it. With the
    length it also tells whether the last line has its line feed.
    """
    dealt = fan is None and LINE_BLOCK in raw.columns
    fan = BLOCK_LINES if fan is None else fan
    content = F.col("raw")
    first, file = F.col("line_number") == 1, ("path", "file_name", "length")
    seen = raw if set(LINE_FACTS) <= set(raw.columns) else with_line_facts(raw)
    leaves = seen.select(
        *file, "line_number", (F.col(LINE_BLOCK) if dealt else line_block(F.col("line_number"), fan)).alias("block"),
        F.sha2(F.concat(F.concat(F.col("line_number").cast("string"), F.lit("|")).cast("binary"), content), 256).alias("digest"),
        F.col("line_number").alias("last_line"), F.when(first, bom(content)).alias("mark"),
        *(name for name in _TOGETHER if name in LINE_FACTS),
    )
    if not dealt:
        leaves = leaves.withColumn("digest", F.unhex("digest"))
    together = [how(name).alias(name) for name, how in _TOGETHER.items()]
    # Digests of dealt lines are folded where they are, and need not be made shorter for it.
    blocks = leaves.groupBy(*file, "block").agg(_folded("line_number", dealt).alias("digest"), *together)
    halls = blocks.groupBy(*file, F.floor(F.col("block") / fan).alias("hall")).agg(_folded("block").alias("digest"), *together)
    summary = halls.groupBy(*file).agg(_folded("hall").alias("digest"), *together)
    digest = F.sha2(F.concat_ws("|", F.col("length").cast("string"), F.lower(F.hex("digest"))), 256)
    encoding = choose_encoding(F.col("utf8"), F.col("mark"), F.col("length") % 2 == 0, F.col("undefined"))
    facts = land(summary.withColumn("source_file_hash", digest).withColumn("encoding", encoding).drop("digest"), "summary")
    chosen = choose_delimiters(raw, facts.where("open AND NOT tab").select("path", "last_line"))
    delimiter = F.when(F.col("tab"), "\t").otherwise(F.coalesce("chosen", F.lit(",")))
    return facts.join(chosen, "path", "left").withColumn("delimiter", delimiter).withColumn(
        "error", file_error(F.col("length"), F.col("encoding").startswith("utf-16") & ~F.col("well_formed"))
    ).select(*FILE_COLUMNS, "last_line", "bare_cr")


def _holds(text: Column, letters: str) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(letter)) for letter in letters])


def choose_delimiters(raw: DataFrame, open_files: DataFrame) -> DataFrame:
    """S4 for files without a tab: path, chosen.

    A line's width is how often a delimiter stands in it outside quotes. The delimiter wins whose most
    frequent width above zero has most lines, then the wider one, then the earlier of ``; | ,``. Dealt lines are counted
    where they have met these files (path, last_line), others before, as there are few widths in a file; lines with a tab are in none of them.
    """
    if open_files.isEmpty():
        return open_files.select("path", F.lit(None).cast("string").alias("chosen"))
    text, latin, content = F.col("text"), _latin1(F.col("raw")), F.col("raw").cast("string")
    tabbed = F.when(F.col("wide").isNull(), F.contains(content, F.lit("\t"))).when(F.col("wide") == "FFFE", latin.rlike(r"(?s)\A(?:..)*?\t\x00")).otherwise(
        latin.rlike(r"(?s)\A(?:..)*?\x00\t")
    )
    lines = raw.where(~F.col("tab") & (F.col("open") | _holds(content, ","))) if "tab" in raw.columns else raw.where(_holds(content, ";|,") & ~tabbed)
    if LINE_BLOCK in raw.columns:
        lines = join_dealt(lines, open_files, "line_number", "last_line")
    lines = _with_text(lines).select("path", "text")
    bare = F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, '"[^"]*+(?:"|\\z)', "")).otherwise(text)
    lines = lines.select("path", bare.alias("bare"))
    width = lambda d: (F.octet_length("bare") - F.octet_length(F.replace("bare", F.lit(d)))).alias(f"w{CHOSEN_FROM.index(d)}")
    # Equal triples of widths first, then each delimiter's own.
    triples = lines.select("path", *map(width, CHOSEN_FROM)).groupBy("path", "w0", "w1", "w2").agg(F.count(F.lit(1)).alias("m"))
    if LINE_BLOCK not in raw.columns:
        triples = triples.join(open_files, "path", "left_semi")
    widths = F.array(*[F.struct(F.lit(-i).alias("order"), F.col(f"w{i}").alias("width")) for i in range(len(CHOSEN_FROM))])
    counted = triples.select("path", "m", F.inline(widths)).where("width > 0").groupBy("path", "order", "width").agg(F.sum("m").alias("n"))
    best = F.max_by("order", F.struct("n", "width", "order"))
    names = F.array(*[F.lit(d) for d in CHOSEN_FROM])
    return counted.groupBy("path").agg(best.alias("best")).select("path", F.element_at(names, 1 - F.col("best")).alias("chosen"))


def spanning_files(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Paths of files with a quoted field over several lines (S6). Only lines with a quote in them are decoded for it."""
    quoted = raw.where(_holds(F.col("raw").cast("string"), '"'))
    opens = leaves_open(F.col("line"), F.col("delimiter"))
    return land(decode_lines(quoted, files.where("NOT bare_cr")).where(opens).select("path").distinct().unionByName(files.where("bare_cr").select("path")), "spanning_files")


def with_line(joined: DataFrame) -> DataFrame:
    """Lines (line_number, raw, and ``ascii`` if it is known) that have met the encoding of their file, with their text as ``line``."""
    text = decode(F.col("raw"), F.col("encoding"), F.col("ascii") if "ascii" in joined.columns else None)
    return joined.withColumn("line", F.when(F.col("line_number") == 1, F.regexp_replace(text, "^\ufeff", "")).otherwise(text))


def records_by_line(raw: DataFrame, files: DataFrame) -> DataFrame:
    """The lines of ``files`` (encoding, delimiter, last_line and any other facts) as one record each, and whether it ``opens`` a field.

    Where a line does, or has a bare carriage return, its file has to be read by ``read_file_records``; the other records are
    those of that reader, with the facts of their file. All lines meet their file once.
    """
    lines = with_line(join_dealt(_pieces(raw, "ascii"), files, "line_number", "last_line"))
    opens = F.contains("line", F.lit('"')) & leaves_open(F.col("line"), F.col("delimiter"))
    return one_per_line(lines, [c for c in files.columns if c not in ("encoding", "last_line")], opens)


def telling_records(raw: DataFrame, files: DataFrame) -> DataFrame:
    """The lines that may hold a label (``named``) as records, and those that open a field (``opens``), in one pass. Other lines are not decoded unless they are ``quoted``."""
    found = raw.where(F.col(NAMED) | F.col("quoted"))
    lines = with_line(join_dealt(_pieces(found, "ascii", NAMED, "quoted"), files, "line_number", "last_line"))
    opens = F.when(F.col("quoted"), leaves_open(F.col("line"), F.col("delimiter"))).otherwise(False)
    # In a step that the filter is not moved over: there it would make the text of a line several times.
    seen = lines.select("path", "line_number", "line", "delimiter", NAMED, F.explode(F.array(opens)).alias("opens")).where(F.col(NAMED) | F.col("opens"))
    return one_per_line(seen, ["path", "delimiter", NAMED], F.col("opens"))


def read_by_line(files: DataFrame) -> DataFrame:
    """The files without an error whose lines may be records of their own."""
    return files.where(F.col("error").isNull() & ~F.col("bare_cr"))


def read_by_scan(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Paths of the files whose records are not their lines, out of rows with ``opens``. There are few or none."""
    bare = files.where(F.col("error").isNull() & F.col("bare_cr")).select("path")
    return land(rows.where("opens").select("path").distinct().unionByName(bare), "spanning_files")


def decode_lines(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Lines as text, out of ``whole_lines`` and ``describe_byte_lines``; only of the ``files`` given."""
    facts = files.where(F.col("error").isNull()).select("path", "encoding", "delimiter", "last_line", "bare_cr")
    lines = with_line(join_dealt(_pieces(raw, "ascii"), facts, "line_number", "last_line"))
    if files.where("bare_cr").isEmpty():
        return lines.select(*LINE_COLUMNS)
    # A carriage return without a line feed ends a line too, so later lines of such a file move down.
    pieces = F.split(F.regexp_replace("line", "\r(?!\\z)", "\u0000\n"), "\u0000\n")
    moved = _running(lines.where("bare_cr").withColumn("pieces", pieces), F.size("pieces") - 1, "more")
    moved = moved.select("path", "delimiter", F.col("line_number").alias("own"), "more", F.posexplode("pieces").alias("piece", "line"))
    moved = moved.withColumn("line_number", F.col("own") + F.col("more") + F.col("piece"))
    return lines.where("NOT bare_cr").select(*LINE_COLUMNS).unionByName(moved.select(*LINE_COLUMNS))


# --- folders --------------------------------------------------------------------------------


def _described(raw: DataFrame, empty: DataFrame, parts: int, words: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``(files, raw)`` out of byte lines, and empty files, landed once."""
    raw = dealt_lines(with_line_facts(whole_lines(dealt_lines(raw, parts)), words), parts, "whole_lines")
    nothing = F.lit(None).cast("string")
    empty = empty.withColumns({
        "source_file_hash": F.sha2(F.lit("0||").cast("binary"), 256), "encoding": nothing, "delimiter": nothing,
        "error": file_error(F.col("length"), F.lit(False)), "last_line": F.lit(0).cast("bigint"), "bare_cr": F.lit(False),
    })
    return land(describe_byte_lines(raw).unionByName(empty), "files"), raw


def describe_files(spark: SparkSession, directory: str | list[str], glob: str = "*.csv", words: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(files, raw)`` of a folder, or of single files: their facts and their byte lines, marked where they may hold one of the ``words``."""
    require_files(spark, directory, glob)
    return _described(read_byte_lines(spark, directory, glob), empty_files(spark, directory, glob), _parts(spark, directory, glob), words)


def describe_paths(spark: SparkSession, paths: list[str], empty: DataFrame, glob: str = "*.csv", words: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(files, raw)`` of files named one by one, of which there may be none, and of ``empty`` ones."""
    nothing = "path string, file_name string, length bigint, line_number bigint, raw binary"
    if not paths:
        return _described(spark.createDataFrame([], nothing), empty, 1, words)
    return _described(read_byte_lines(spark, paths, glob), empty, _parts(spark, paths, glob), words)


def _parts(spark: SparkSession, places: str | list[str], glob: str) -> int:
    """Buckets for the lines of files, by their size."""
    size = binary_files(spark, places, glob).agg(F.sum("length")).first()[0]
    return max(1, -(-(size or 0) // DEAL_BYTES))


def read_files(spark: SparkSession, directory: str | list[str], glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """``(files, lines)`` of a folder, or of single files."""
    files, raw = describe_files(spark, directory, glob)
    return files.select(*FILE_COLUMNS), decode_lines(raw, files)


def read_file_records(raw: DataFrame, files: DataFrame) -> DataFrame:
    """The records of files, each under its own delimiter, out of ``describe_files``; every line is decoded once."""
    return read_records(decode_lines(raw, files), spanning=spanning_files(raw, files))
