"""Mixing sources to target weights (operator 5), in DataFrame expressions only.

Method: Efraimidis-Spirakis sampling. A document's key is -ln(u) / weight, with u from a digest of its id
and text and the weight from its quality; ascending keys are a weighted sample without replacement.
Each source first gives the whole epochs its target holds, then the documents at the head of its key
order whose sizes, added up, come to the rest of the target.

Sizes are added up in two steps, so that no task holds a source: documents fall into about sqrt(n)
slices of their source by a rising function of the key, slices are added up, and a window runs within
a slice only.

Defined cases: a null text has size 0, a null source is a source of its own, without a quality the
weight is 1. Rows that repeat id, text and source count as often as they stand there and have one place
in the order. A document is taken whole; the one across the end of the rest is taken if half of it or
more fits. Documents of size 0 take nothing. A source of size 0 has target 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.keys import unpacked, whole
from rollcall.storage import land

WORD = r"[^\x20\x09-\x0D]+"
#: Of all sizes together; of a source's own size; weights of sources in order, repeating.
SHARE, MOST_EPOCHS, WEIGHTS = 1.5, 2, (5, 2, 1)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest of id and text."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` with ``weight``: sources by code point, null last, take the weights in turn. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, share: float = SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``target`` per source from ``source_size`` and ``weight``, none above ``most_epochs`` times its size.

    Resharing the excess by weight ends at one level of target per weight: sources whose limit per weight
    lies below the level stay at their limit. The level follows from sources in order of that limit.
    One row per source, so the window holds as many rows as there are sources.
    """
    most = (F.col("source_size") * most_epochs).cast("double")
    order = Window.orderBy("at", F.col("source").asc_nulls_last())
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    steps = sources.withColumn("most", most).withColumn("at", F.col("most") / F.col("weight"))
    steps = steps.withColumn("level", (total * share - (F.sum("most").over(order) - F.col("most"))) / F.sum("weight").over(behind))
    level = F.min(F.when(F.col("level") <= F.col("at"), F.struct("at", "level"))).over(Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    aim = F.coalesce(F.least(F.col("most"), level["level"] * F.col("weight")), F.col("most"))
    return steps.select("source", "source_size", aim.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """doc_id, text_mark, source, size, source_size, target, taken and ``times`` for every row of ``docs``.

    ``quality``: doc_id and a positive ``weight`` per document; documents without one have weight 1.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_mark"), F.col("source"),
        words(F.col("text")).alias("size"), uniform(F.col("doc_id"), F.col("text")).alias("u"),
    )
    units = sized.groupBy("doc_id", "text_mark", "source", "size", "u").agg(F.count("*").alias("copies"))
    if quality is None:
        units = units.withColumn("weight", F.lit(1.0))
    else:
        units = units.join(quality.select("doc_id", "weight"), "doc_id", "left").withColumn("weight", F.coalesce(F.col("weight"), F.lit(1.0)))
    units = land(units.withColumn("key", -F.log("u") / F.col("weight")), "units")

    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.ceil(F.sqrt(F.count("*"))).alias("slices"), F.avg("weight").alias("mean")
    )
    n = units.count()  # there are no more sources than documents
    sources = land(sources, "sources", n)
    aims = targets(source_weights(sources.select("source", "source_size"), weights), share, most_epochs)
    aims = aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    aims = aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    facts = land(_with(sources.select("source", "slices", "mean"), aims, "source"), "targets", n)

    # 1 - exp(-key * mean) is about even on [0, 1) and rises with the key.
    placed = _with(units, facts, "source").withColumn(
        "slice", F.least(F.floor((1 - F.exp(-F.col("key") * F.col("mean"))) * F.col("slices")), F.col("slices") - 1)
    )
    slices = placed.groupBy("source", "slice").agg(F.sum(F.col("size") * F.col("copies")).alias("own"))
    upto = Window.partitionBy("source").orderBy("slice")
    before = slices.select("source", "slice", (F.sum("own").over(upto) - F.col("own")).alias("before"))

    order = Window.partitionBy("source", "slice").orderBy("key", F.col("doc_id").asc_nulls_first(), "text_mark")
    at = F.col("before") + F.sum(F.col("size") * F.col("copies")).over(order) - F.col("size") * F.col("copies")
    fits = F.floor((F.col("rest") - F.col("at")) / F.col("size") + 0.5)
    chosen = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(fits, F.col("copies")))).otherwise(F.lit(0))
    taken = _with(placed, before, "source", "slice").withColumn("at", at).withColumn("chosen", chosen)
    rows = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    times = F.when(F.col("size") > 0, F.col("epochs") + (F.col("copy") <= F.col("chosen")).cast("long")).otherwise(F.lit(0).cast("long"))
    return rows.withColumn("times", times).select(
        "doc_id", "text_mark", "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times"
    )


def _with(rows: DataFrame, facts: DataFrame, *keys: str) -> DataFrame:
    """Join on keys of which null is a value too."""
    other = facts.select(*(F.col(k).alias(f"other_{k}") for k in keys), *(c for c in facts.columns if c not in keys))
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(other[f"other_{k}"])
    return rows.join(other, same).drop(*(f"other_{k}" for k in keys))


def mixed(docs: DataFrame, quality: DataFrame | None = None, **settings) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it, with their columns."""
    times = mix(docs, quality, **settings).filter("times > 0")
    # Rows that repeat id, text and source share their count evenly, the first of them take what is left over.
    counts = times.groupBy("doc_id", "text_mark", "source").agg(F.sum("times").alias("mix_times"))
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(whole(docs).alias("document"), F.col("doc_id").cast("long").alias("doc_id"), mark.alias("text_mark"), "source")
    own = Window.partitionBy("doc_id", "text_mark", "source")
    found = _with(rows, counts, "doc_id", "text_mark", "source")
    found = found.withColumn("copies", F.count("*").over(own)).withColumn("copy", F.row_number().over(own.orderBy("mix_times")))
    now = F.floor(F.col("mix_times") / F.col("copies")) + (F.col("copy") <= F.col("mix_times") % F.col("copies")).cast("long")
    found = found.withColumn("now", now).filter("now > 0")
    return found.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("now")))).select(*unpacked(docs, "document"))


def op5_mixing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix of whole ``docs`` with quality weights from ``labels``: 2 for good, 0.5 for bad, 1 without a label."""
    return mix(docs, quality_weights(labels)).select("doc_id", "size", "source_size", "target", "taken")


def quality_weights(labels: DataFrame) -> DataFrame:
    graded = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    return graded.select("doc_id", (F.lit(0.5) + 1.5 * F.col("quality")).alias("weight"))
