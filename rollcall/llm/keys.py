"""Row identity that holds up with null and repeated ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names that callers' tables may carry too; operators pick the columns they need before they add these.
DOC, MARK = "doc_id", "text_mark"


def marked(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, a 64-bit mark of the text, the text (null: empty) and further ``columns`` of ``docs``.

    Id and mark together name a document. Rows that repeat both are one document given twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(DOC).cast("long").alias(DOC), F.xxhash64(text).alias(MARK), text.alias("text"), *columns)


def others(rows: DataFrame, *names: str) -> list[str]:
    """The columns of ``rows`` without ``names``, quoted; Spark does not tell capitals from small letters in names."""
    return [f"`{c.replace('`', '``')}`" for c in rows.columns if c.lower() not in names]


def whole(rows: DataFrame, *without: str) -> Column:
    """All columns of a row but ``without`` as one struct, so that no name in it meets the names of an operator."""
    kept = others(rows, *without)
    return F.struct(*(F.col(c) for c in kept)) if kept else F.struct(F.lit(None).alias("none"))


def unpacked(rows: DataFrame, packed: str, *without: str) -> list[Column]:
    """The columns of a struct that ``whole`` made of ``rows``."""
    return [F.col(packed)[c[1:-1].replace("``", "`")].alias(c[1:-1].replace("``", "`")) for c in others(rows, *without)]


def same_document(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on id and mark; null ids meet too, and the mark keeps them from meeting in one task."""
    return left[DOC].eqNullSafe(right[DOC]) & (left[MARK] == right[MARK])


def byte_slices(texts: pa.StringArray, most: int) -> Iterator[tuple[int, int]]:
    """First and last place of runs of texts that hold up to ``most`` bytes together, or one longer text; nulls hold none."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)))
        yield at, upto
        at = upto
