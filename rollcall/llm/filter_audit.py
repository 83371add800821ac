"""What each of several filters does alone, together and in every order (operator 13).

Method: a walk over all subsets of the filters in Gray code. Documents are reduced to cells first: a cell is a
set of filters that a document fails, as bits of a mask, with its counts of documents, good and toxic ones,
so at most 32 cells per part stay of five filters. The walk starts without a filter and toggles one at a time.
Each cell has a counter of the active filters it fails; a cell leaves the running survivors when its
counter goes from 0 to 1 and comes back when it goes from 1 to 0. The survivors of all 32 subsets are
stored, and all else is a difference of two stored states: what a step removes, what it finds already gone, what
only one filter catches, and how a filter's removals add up over all orders.

The walk sees cells only, so its work does not grow with the documents. Texts are read once, the rest of the way
goes on with a digest of each. Copies are found by the smallest id of a digest, aggregated before it is
shuffled, and only digests that stand twice are joined to the rows, by a join that Spark can split.

Defined cases: a null text is empty, a null source is the part ``''``. Of equal texts the rows with the smallest
id pass ``E``; a row without an id neither fails it nor makes others fail. A document is good or toxic if
any label row of its id says so; labels without an id count for nothing. Repeated rows are documents of their
own. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.storage import land

WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Filters in order of their bits; the last looks at the whole table, the others at one text.
LETTERS = "ABCDE"
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, r"[#$%&*|]"
_COUNTS = ("n", "good", "toxic")


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask (bit k: the document fails filter k of ``LETTERS``) for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("text"),
        F.array_remove(F.split(text, WORD_BREAK, -1), "").alias("words"),
    )
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = (
        words < FEWEST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT * words.cast("long"),
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > MOST_CAPITALS * F.length("text").cast("long"),
        F.col("text").rlike(SYMBOLS),
    )
    mask = sum((fail.cast("int") * (1 << k) for k, fail in enumerate(fails)), F.lit(0))
    rows = land(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "failures")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "first")
    copies = land(copies, "copies")  # read back, it is dealt out for the join itself, which only then can be split
    repeats = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).cast("int") * (1 << len(fails))
    return rows.join(copies, "digest", "left").select("doc_id", "part", (F.col("mask") + repeats).alias("mask"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail just the filters of a mask. At most one row per mask."""
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).cast("int").alias("is_good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).cast("int").alias("is_toxic")
    )
    return rows.join(said, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("is_good"), F.lit(0)).cast("long").alias("good"), F.coalesce(F.sum("is_toxic"), F.lit(0)).cast("long").alias("toxic")
    )


def toggles(filters: int) -> list[int]:
    """The bit that each step of a Gray code walk over all subsets of ``filters`` filters toggles."""
    return [step & -step for step in range(1, 1 << filters)]


def _sums(sign: Column, *rows: Column) -> Column:
    return F.struct(*(sum((r[c] * s for r, s in zip(rows, (F.lit(1), sign), strict=False)), F.lit(0).cast("long")).alias(c) for c in _COUNTS))


def survivors(found: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """part and ``states``: a map from each subset of the filters to the counts of the documents that pass all of it."""
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in _COUNTS))
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", *_COUNTS)).alias("cells"))
    everything = F.aggregate("cells", zero, lambda total, cell: _sums(F.lit(1), total, cell))
    parts = parts.select("part", "cells", everything.alias("total"), F.transform("cells", lambda _: F.lit(0)).alias("counters"))

    def step(at: Column, bit: Column) -> Column:
        on = at["active"].bitwiseAND(bit) == 0
        # Before the toggle: a cell without an active failure leaves, one with this failure alone comes back.
        edge, change = F.when(on, F.lit(0)).otherwise(F.lit(1)), F.when(on, F.lit(1)).otherwise(F.lit(-1))
        failing = F.zip_with("cells", at["counters"], lambda cell, count: F.when((cell["mask"].bitwiseAND(bit) != 0) & (count == edge), cell))
        left = F.aggregate(failing, at["passing"], lambda total, cell: F.when(cell.isNull(), total).otherwise(_sums(-change, total, cell)))
        counters = F.zip_with("cells", at["counters"], lambda cell, count: F.when(cell["mask"].bitwiseAND(bit) != 0, count + change).otherwise(count))
        active = at["active"].bitwiseXOR(bit)
        return F.struct(active.alias("active"), left.alias("passing"), counters.alias("counters"), F.concat(at["states"], F.array(F.struct(active.alias("subset"), left.alias("passing")))).alias("states"))

    start = F.struct(
        F.lit(0).alias("active"), F.col("total").alias("passing"), F.col("counters").alias("counters"), F.array(F.struct(F.lit(0).alias("subset"), F.col("total").alias("passing"))).alias("states")
    )
    walked = F.aggregate(F.array(*map(F.lit, toggles(filters))), start, step, lambda at: at["states"])
    return parts.select("part", F.map_from_entries(walked).alias("states"))


def steps(states: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters, step by step, out of the stored survivors of the subsets."""
    size = len(letters)
    orders = ["".join(p) for p in permutations(letters)]
    rows = states.select("part", "states", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    rows = rows.select("part", "states", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    bits = F.create_map(*(F.lit(x) for k, c in enumerate(letters) for x in (c, 1 << k)))
    at = lambda place: bits[F.substr("filter_order", place, F.lit(1))]
    before = F.aggregate(F.sequence(F.lit(1), F.lit(size)), F.lit(0), lambda mask, place: mask + F.when(place < F.col("step"), at(place)).otherwise(F.lit(0)))
    rows = rows.select("part", "states", "filter_order", "step", before.alias("before"), at(F.col("step")).alias("bit"))

    state, bit, everyone = F.col("states"), F.col("bit"), (1 << size) - 1
    passing, after = state[F.col("before")], state[F.col("before") + bit]
    removed = passing["n"] - after["n"]
    # So many orders have just the filters of a subset ahead of one.
    orders_behind = F.array(*(F.lit(factorial(k) * factorial(size - 1 - k)).cast("long") for k in range(size)))
    removals = F.aggregate(
        F.sequence(F.lit(0), F.lit(everyone)), F.lit(0).cast("long"),
        lambda total, subset: total + F.when(
            subset.bitwiseAND(bit) == 0, orders_behind[F.bit_count(subset)] * (state[subset]["n"] - state[subset.bitwiseOR(bit)]["n"])
        ).otherwise(F.lit(0).cast("long")),
    )
    return rows.select(
        "part", "filter_order", "step", after["n"].alias("kept"), removed.alias("removed"),
        (state[F.lit(0)]["n"] - state[bit]["n"] - removed).alias("redundant"),
        (state[F.lit(everyone) - bit]["n"] - state[F.lit(everyone)]["n"]).alias("unique_fails"),
        (passing["good"] - after["good"]).alias("good_lost"), (passing["toxic"] - after["toxic"]).alias("toxic_lost"), removals.alias("shapley"),
    )


def op13_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with whole counts within the part."""
    return steps(survivors(cells(failures(docs), labels)))
