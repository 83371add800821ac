"""Text cleaning. Every function maps a Column (or column name) to a Column."""

from __future__ import annotations

import re
import sys
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

# All white space characters, where SQL trim alone takes blanks.
_SPACE = "".join(chr(point) for point in range(sys.maxunicode + 1) if chr(point).isspace())


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """SQL trim, with the empty text read as null.

    Not written with nullif: Spark plans that with a name of its own per use, and expressions
    built on it are then no longer recognised as equal and computed once.
    """
    text = F.trim(col(c))
    return F.when(text != "", text)


_VISIBLE = "[^" + "".join(f"\\x{{{ord(ch):x}}}" for ch in _SPACE) + "]"


def is_visible(c) -> Column:
    """Whether anything is left after ``strip``; the text is looked at up to its first such character only."""
    return col(c).rlike(_VISIBLE)


def is_ascii(content: Column) -> Column:
    """Whether all bytes are ASCII: these are the same text in UTF-8, windows-1252 and ISO-8859-1. Any other byte makes two out of one here."""
    return F.octet_length(F.decode(content, "ISO-8859-1")) == F.octet_length(content)


def strip(c) -> Column:
    """Remove all leading and trailing whitespace, not only blanks."""
    return F.trim(col(c), F.lit(_SPACE))


@cache
def _fold_rules() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose full case folding differs from lower case: one-to-one and one-to-many."""
    single, multi = {}, {}
    for point in range(sys.maxunicode + 1):
        lowered = chr(point).lower()
        if len(lowered) == 1 and lowered == chr(point) and lowered.casefold() != lowered:
            folded = lowered.casefold()
            (single if len(folded) == 1 else multi)[lowered] = folded
    return single, multi


def casefold(c) -> Column:
    """Unicode full case folding."""
    single, multi = _fold_rules()
    lowered = F.lower(col(c))
    special = "[" + "".join(single) + "".join(multi) + "]"
    table = F.create_map(*[F.lit(x) for pair in multi.items() for x in pair])
    letters = F.split(F.translate(lowered, "".join(single), "".join(single.values())), "")
    folded = F.array_join(
        F.transform(letters, lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    wide = F.length(lowered) != F.octet_length(lowered)
    return F.when(wide & lowered.rlike(special), folded).otherwise(lowered)


@cache
def _label_letters() -> str:
    """Letters outside ASCII that fold to text with ASCII letters in it, such as the sharp s."""
    single, multi = _fold_rules()
    return "".join(ch for ch, folded in {**single, **multi}.items() if any("a" <= f <= "z" for f in folded))


def may_hold_label(text: Column, words: str) -> Column:
    """A cheap test that a text can hold one of the words (a pattern) once it is normalised."""
    # None of the letters is ASCII.
    return F.lower(text).rlike(words) | (~is_ascii(text.cast("binary")) & text.rlike(f"[{_label_letters()}]"))


@cache
def _label_forms() -> frozenset[str]:
    """Those letters, and marks that are left out of labels, as bytes in any encoding, seen through ISO-8859-1 without zeros."""
    forms = set()
    for letter in [*_label_letters(), "\ufeff"]:
        for encoding in ("utf-8", "cp1252", "latin-1", "utf-16-le", "utf-16-be"):
            try:
                forms.add(letter.encode(encoding).replace(b"\0", b"").decode("latin-1"))
            except UnicodeEncodeError:
                continue
    return frozenset(forms - {""})


@cache
def _label_bytes() -> str:
    firsts = "".join(sorted({f"\\x{ord(form[0]):02x}" for form in _label_forms()}))
    return f"(?=[{firsts}])(?:" + "|".join(re.escape(form) for form in sorted(_label_forms())) + ")"


@cache
def _label_signs() -> tuple[str, ...]:
    """Every form that is all ASCII, as some are in UTF-16, has one of these characters."""
    return tuple(sorted({min(form) for form in _label_forms() if form.isascii()}))


def label_bytes(line: Column, words: tuple[str, ...]) -> Column:
    """A cheap test that a line, as bytes in any encoding, can hold one of the words once it is normalised."""
    return F.exists(_label_views(line), lambda seen: _may_name(seen, words))


def label_lines(raw: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """The lines (raw) that pass ``label_bytes``. What is looked at is made once per line, in a step that filters are not moved over."""
    return raw.select("*", F.explode(_label_views(F.col("raw"))).alias("_seen")).where(_may_name(F.col("_seen"), words)).drop("_seen")


def without_zeros(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\u0000")), F.replace(text, F.lit("\u0000"), F.lit(""))).otherwise(text)


def may_name(text: Column, letters: Column, plain: Column, decoded: Column, words: tuple[str, ...]) -> Column:
    """``label_bytes`` of a line whose text (``without_zeros``) and its ``letters`` in lower case are known.

    The text is ``plain`` (all ASCII), ``decoded`` in full, or the bytes of the line seen through ISO-8859-1.
    """
    named = reduce(Column.__or__, [F.contains(letters, F.lit(word)) for word in words])
    return named | (~plain & F.when(decoded, letters.rlike(f"[{_label_letters()}\ufeff]")).otherwise(text.rlike(_label_bytes())))


def _label_views(line: Column) -> Column:
    """One struct: the letters to look for words in, and the bytes as ``_label_forms`` sees them where one of these may be among them.

    The words are ASCII, and a text without other letters is put into lower case byte by byte.
    """
    plain, content = is_ascii(line), line.cast("string")
    bare = F.replace(content, F.lit("\u0000"), F.lit(""))
    seen = F.replace(F.decode(line, "ISO-8859-1"), F.lit("\u0000"), F.lit(""))
    odd = reduce(Column.__or__, [F.contains(content, F.lit(sign)) for sign in _label_signs()], ~plain)
    letters = F.lower(F.when(plain, bare).otherwise(F.regexp_replace(seen, "[^\\x00-\\x7f]+", " ")))
    return F.array(F.struct(letters.alias("letters"), F.when(odd, seen).alias("bytes")))


def _may_name(seen: Column, words: tuple[str, ...]) -> Column:
    named = reduce(Column.__or__, [F.contains(seen["letters"], F.lit(word)) for word in words])
    return named | F.coalesce(seen["bytes"].rlike(_label_bytes()), F.lit(False))


def normalise_label(c) -> Column:
    """Section and column labels: folded, every run of other characters becomes one blank."""
    visible = F.replace(F.replace(col(c), F.lit("\ufeff"), F.lit("")), F.lit("\u0000"), F.lit(""))
    return F.trim(F.regexp_replace(casefold(visible), "[^a-z0-9]+", " "))


def normalise_header(c) -> Column:
    """Column headers in snake case."""
    words = F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_")
    return F.trim(words, F.lit("_"))


def normalise_email(c) -> Column:
    """Null becomes empty, otherwise stripped and lower case (P5)."""
    return F.lower(strip(F.coalesce(col(c), F.lit(""))))


def normalise_name(c) -> Column:
    """Null becomes empty, otherwise stripped (P5)."""
    return strip(F.coalesce(col(c), F.lit("")))


def match_key(email="email", participant_id="participant_id", name="participant_name") -> Column:
    """Who a row is about: email, else participant id, else name."""
    return F.coalesce(F.lower(col(email)), col(participant_id), F.lower(col(name)))


def session_key(title, start) -> Column:
    """Business key of a meeting: hash of the folded title and the start text."""
    return F.sha2(F.concat_ws("|", casefold(strip(title)), strip(start)), 256)
