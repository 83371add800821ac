"""From raw documents to packed sequences, stage by stage.

Each stage calls one operator on all that the stage before kept. Documents that the toxicity model rejects go;
lines that stand earlier are cut out, and documents that consist of nothing else go; of each group
of near duplicates one document stays; sources are mixed to their targets, so a document may come once,
twice or not at all; what is left is packed into sequences. Between the stages the table has the columns
of ``documents``; ``n_chars`` follows the text.

Defined cases: null and empty texts go through all stages and give a sequence nothing but their end id. Null ids and ids
on several rows or texts keep their rows apart; a row that repeats id and text is the same document once more, lines
of both count as one place, and of a group only one such row stays. Null sources are a source. Other columns go along up to
the last stage, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import lines, mixing, near_text, queries, toxicity
from rollcall.llm.keys import unpacked, whole
from rollcall.storage import land

#: Words that a worker remembers while it packs: fewer than a worker that does nothing else, as its memory also served the stages before.
KEPT_WORDS = 500_000
#: Texts are near duplicates from this similarity in percent on; operator 2 has a threshold of its own.
SIMILAR = 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that are likelier toxic than not."""
    found = toxicity.scored(docs, toxicity.train(docs, queries.labels(spark, sf_dir)))
    return found.filter("NOT toxic").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; those with no other lines go, empty ones stay."""
    found = lines.line_dedup(docs).filter("n_removed < n_lines OR n_lines = 0")
    cut = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", cut).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id (ids come before null), and of rows that repeat it one.

    Groups are told apart by their roots, so a shared id joins no texts and a null id parts none. Empty texts are in no group.
    """
    found = near_text.near_duplicates(docs, SIMILAR).select("doc_id", "text_mark", "root")
    n = docs.count()
    found = land(found, "near_duplicates", n)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_mark")))
    chosen = found.filter("root IS NOT NULL").groupBy("root").agg(first.alias("first")).select(F.col("first.doc_id"), F.col("first.text_mark"), F.lit(False).alias("alone"))
    chosen = chosen.union(found.filter("root IS NULL").select("doc_id", "text_mark", F.lit(True)).distinct())
    # Null ids as values of their own, so that the join and the dropping of repeated rows share one shuffle of the texts.
    id_or_0, keys = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), ["id", "no_id", "mark"]
    chosen = chosen.select(id_or_0, F.col("doc_id").isNull().alias("no_id"), F.col("text_mark").alias("mark"), "alone")
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(whole(docs).alias("document"), id_or_0, F.col("doc_id").isNull().alias("no_id"), mark.alias("mark"))
    own = F.when(F.col("alone"), F.monotonically_increasing_id())  # rows that are in no group all stay
    rows = rows.join(land(chosen, "kept", n), keys).withColumn("own", own)
    return rows.dropDuplicates([*keys, "own"]).select(*unpacked(docs, "document"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, documents as often as it takes them."""
    return mixing.mixed(docs, mixing.quality_weights(queries.labels(spark, sf_dir)))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place."""
    return queries.packed(docs, KEPT_WORDS)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near-duplicate texts", without_near_duplicates),
    ("mixing to target weights", to_target_weights),
    ("best-fit packing", into_sequences),
]

#: Regression, sketches and packing are not SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written once before the next reads it."""
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
