"""Joining rows with facts about their file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_ROWS = 1_000_000

#: Lines in a block when something is counted along a file, and the column that names the block of a dealt line.
BLOCK_LINES = 10_000
LINE_BLOCK = "line_block"


def line_block(position: Column, block_lines: int = BLOCK_LINES) -> Column:
    return F.floor((position - 1) / block_lines)


def join_dealt(rows: DataFrame, facts: DataFrame, position: str, last: str) -> DataFrame:
    """``join_file_facts`` by path; of rows that are dealt by path and ``LINE_BLOCK`` only the facts are moved.

    There is one row of facts per block, so those of a bucket are few and are looked up without sorting its lines.
    """
    if LINE_BLOCK not in rows.columns:
        return join_file_facts(rows, facts, ["path"], position, last)
    repeated = facts.withColumn(LINE_BLOCK, F.explode(F.sequence(F.lit(0).cast("bigint"), line_block(F.greatest(F.col(last), F.lit(1))))))
    return rows.join(repeated.hint("shuffle_hash"), ["path", LINE_BLOCK])


def join_file_facts(rows: DataFrame, facts: DataFrame, keys: list[str], position: str, last: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, which has one row per file, by ``keys``.

    Files differ in size without limit, and one may hold a third of all rows. So the key is the
    file and a block of its rows (``position``), and the facts of a file are repeated once per
    block up to its ``last`` row: once for nearly every file, often for a huge one. A task then
    never gets more than some blocks, however the join is done and whatever follows it.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(position) / block_rows))
    repeated = facts.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col(last) / block_rows))))
    return blocked.join(repeated, [*keys, "_block"]).drop("_block")
