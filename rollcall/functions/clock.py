"""Timestamps and durations as meeting exports write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.text import blank_to_null, col

_STAMP = (
    r"(?i)^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2}),?\s*(0?[1-9]|1[0-2]):([0-5]?\d)(?::([0-5]?\d))?\s*(AM|PM)\z"
)
_MARK = "\u0001"
_PARTS = "".join(f"{_MARK}${i}" for i in range(1, 8))


def timestamp_parts(c) -> Column:
    """The parts 1 to 7 of a ``M/D/YY, H:MM[:SS] AM`` text; only a part 0 for any other text.

    One pass of the pattern: a text it matches comes out as its parts with a mark before each, and
    a text it does not match comes out as it was.
    """
    marked = F.regexp_replace(blank_to_null(c), _STAMP, _PARTS)
    return F.split(marked, _MARK)


def timestamp_of(parts) -> Column:
    """The zone-free timestamp of ``timestamp_parts``; null where the date does not exist.

    Two-digit years 00-49 are in the 2000s and 50-99 in the 1900s. The timestamp is made from its
    fields, so the session time zone and its gaps have no part in it.
    """
    # As a variable the parts are made once, also where the timestamp is part of a filter.
    return F.get(F.transform(F.array(col(parts)), _made_of), 0)


def _made_of(parts: Column) -> Column:
    # All parts are digits or missing, so no cast fails; a failing try_cast is slow. Missing
    # seconds are an empty part, read as 0.
    number = lambda i: F.get(parts, i).cast("int")
    century = F.when(F.length(F.get(parts, 3)) == 4, 0).when(number(3) < 50, 2000).otherwise(1900)
    afternoon = F.when(F.upper(F.get(parts, 7)) == "PM", 12).otherwise(0)
    seconds = F.concat(F.lit("0"), F.get(parts, 6)).cast("int")
    return F.try_make_timestamp_ntz(
        number(3) + century, number(1), number(2), number(4) % 12 + afternoon, number(5), seconds
    )


def parse_timestamp(c) -> Column:
    """U1 as one expression."""
    return timestamp_of(timestamp_parts(c))


def with_timestamps(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """U1 for several columns (new name to text column), each text matched and split once.

    The parts are columns of their own for one step. That keeps the generated code of each step
    small enough to be compiled, and does not leave it to the optimizer to share the split.
    """
    split = df.withColumns({f"_parts_{new}": timestamp_parts(old) for new, old in columns.items()})
    made = split.withColumns({new: timestamp_of(f"_parts_{new}") for new in columns})
    return made.drop(*[f"_parts_{new}" for new in columns])


def parse_duration(c) -> Column:
    """``1h 2m 3s`` to seconds. Blank is null; text without any such number is 0."""
    # As a variable the text is made once, also where the duration is part of a filter.
    return F.get(F.transform(F.array(F.lower(F.trim(col(c)))), _seconds), 0)


def _seconds(text: Column) -> Column:
    def amount(unit: str) -> Column:
        # The leading zero reads a missing number as 0; a number that is too long becomes null.
        return F.concat(F.lit("0"), F.regexp_extract(text, rf"([0-9]+)\s*{unit}", 1)).try_cast("bigint")

    hours = F.try_multiply(amount("h"), F.lit(3600).cast("bigint"))
    minutes = F.try_multiply(amount("m"), F.lit(60).cast("bigint"))
    return F.when(text != "", F.try_add(F.try_add(hours, minutes), amount("s")))
