"""Near-duplicate documents by their word shingles (operator 2).

Method: fast similarity sketching. A sketch has ``COORDINATES`` bins. In round i every element of the
set is hashed to a bin with a value that grows with i, each bin keeps its smallest value, and rounds go on
until no bin is empty; in the second half of the rounds round i fills one bin for certain, so every
coordinate is filled. Equal coordinates estimate the similarity with the concentration of minwise sketches.

Then banding: bands of coordinates, as many and as wide as ``banding`` finds for the threshold, are hashed to
buckets. Documents with equal sets are one class from the start, so that only classes go on. Links are
confirmed on full sets.

Buckets are worked off without all their pairs. First each class of a bucket meets the bucket's hub, the
class with most company in its buckets; confirmed links give components. Classes of a bucket that are
then in different components are compared too, but only those that can link: elements that no other class of
such buckets has cannot be shared, and of two similar sets, elements in order of how many have them, the first
n - ceil(threshold n) + 1 have one in common, behind whose place enough elements are left in both. So pairs come from rare elements, not from the bucket, and pages
of one template that stay below the threshold make none out of what the template gives them. Signatures of the
sketch must agree as far as a similar pair's would (``agreeing``). So no link is lost but by the sketch's own error:
at any threshold less than one pair in 10^6 that stands at it shares no bucket, and less than one in 10^6 has
signatures too different.

Defined cases: null, empty and blank texts have an empty set and link with nothing. Texts with fewer words
than a shingle have one element, the whole sequence. Rows that repeat an id are separate rows of it. A null
id has the smallest id of its component, which is null if it is alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.graph import components
from rollcall.llm.keys import byte_slices, marked
from rollcall.storage import land

#: Words in a shingle; links from 100 * intersection >= PERCENT * union.
WIDTH, PERCENT = 5, 85
#: Coordinates of a sketch, and how often a pair at the threshold may miss its buckets or the signatures' bound.
COORDINATES, MISSED = 256, 1e-6
#: Bytes of text whose sets are sketched together (or one longer text), and elements hashed in one go.
SLICE, TOGETHER = 1_500_000, 1 << 17

_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEPS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: the widest bands, and as few of them, that a pair at it shares often enough.

    A pair at s shares no band with probability (1 - s^rows)^bands. 36 bands of 7 for 85, 35 of 5 for 80.
    """
    for rows in range(len(_STEPS), 0, -1):
        for bands in range(1, COORDINATES // rows + 1):
            if (1 - (percent / 100) ** rows) ** bands <= MISSED:
                return bands, rows
    raise ValueError(f"{COORDINATES} coordinates are too few for links from {percent} percent")


def agreeing(percent: int) -> int:
    """The most signature bits that a pair at the threshold has in common often enough: 214 for 85, 205 for 80.

    A bit agrees where the coordinates do and in half of the other places.
    """
    same, missed = (1 + percent / 100) / 2, 0.0
    for bits in range(COORDINATES + 1):
        missed += comb(COORDINATES, bits) * same**bits * (1 - same) ** (COORDINATES - bits)
        if missed > MISSED:
            return bits
    return COORDINATES


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit marks of the distinct shingles of a whole text, letters A-Z lowered."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    marks = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    sums = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        sums += marks[k : len(marks) - n + 1 + k] * _STEPS[k]
    # A short sequence is no prefix of a shingle: its length is part of its mark.
    return np.unique(mix(sums + np.uint64(n)))


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of ``coordinates`` values per set; sets are not empty. All sets go through a round together."""
    out = np.full((len(sets), coordinates), _MAX, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for turn in range(2 * coordinates):
        for at in range(0, len(values), TOGETHER):
            hashed = mix(values[at : at + TOGETHER] + np.uint64((turn + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
            if turn < coordinates:
                place = ((hashed >> np.uint64(40)) * np.uint64(coordinates) >> np.uint64(24)).astype(np.int64)
            else:
                place = turn - coordinates
            np.minimum.at(flat, owner[at : at + TOGETHER] * coordinates + place, np.uint64(turn << 40) | (hashed & np.uint64((1 << 40) - 1)))
        if turn % 4 == 3 or len(values) < 5000:
            open_sets = (out == _MAX).any(1)
            going = open_sets[owner]
            if not going.all():
                owner, values = owner[going], values[going]
            if not len(values):
                break
    return out


def buckets(sketch: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The marks of the bands of each sketch."""
    bands, width = banding(percent)
    rows = sketch[:, : bands * width].reshape(len(sketch), bands, width)
    sums = (mix(rows) * _STEPS[:width]).sum(2, dtype=np.uint64)
    return mix(sums + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def signature(sketch: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, as four 64-bit numbers."""
    bits = (mix(sketch) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def described(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_mark, n_shingles, node (128-bit mark of the set), buckets, signature of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in byte_slices(batch.column(2), SLICE):
                some = batch.slice(at, upto - at)
                sets = [shingles(t, width) for t in some.column(2).to_pylist()]
                full = [k for k, s in enumerate(sets) if len(s)]
                sketch = sketches([sets[k] for k in full])
                bands, bits = [None] * len(sets), [None] * len(sets)
                for k, b, s in zip(full, buckets(sketch, percent).tolist(), signature(sketch).tolist(), strict=True):
                    bands[k], bits[k] = b, s
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
                ], names=["doc_id", "text_mark", "n_shingles", "node", "buckets", "signature"])

    schema = "doc_id long, text_mark long, n_shingles long, node binary, buckets array<long>, signature array<long>"
    return marked(docs).mapInArrow(describe, schema)


def set_table(docs: DataFrame, nodes: DataFrame, width: int = WIDTH) -> DataFrame:
    """node, elements (64-bit marks) for ``nodes`` (node, doc_id, text_mark of a document with that set)."""
    wanted = nodes.select("node", F.col("doc_id").alias("of_id"), F.col("text_mark").alias("of_mark"))
    texts = marked(docs)
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["of_id"]) & (texts["text_mark"] == wanted["of_mark"]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in byte_slices(batch.column(1), SLICE):
                some = batch.slice(at, upto - at)
                sets = [shingles(t, width) for t in some.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                elements = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([some.column(0), elements], names=["node", "elements"])

    return found.select("node", "text").mapInArrow(build, "node binary, elements array<long>").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) whose sets satisfy 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", (F.size("x") + F.size("y")).cast("long").alias("both"), shared.alias("shared"))
    return sized.filter(100 * F.col("shared") >= percent * (F.col("both") - F.col("shared"))).select("a", "b")


def _agree(left: str, right: str, percent: int):
    """Enough signature bits in common."""
    differing = sum((F.bit_count(F.col(f"{left}.signature")[k].bitwiseXOR(F.col(f"{right}.signature")[k])) for k in range(4)), F.lit(0))
    return differing <= COORDINATES - agreeing(percent)


def _may_link(low, high, percent: int):
    """Whether sets with ``low`` shareable of ``high`` elements can reach the threshold with an equal or larger one."""
    return 100 * low >= percent * high


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, text_mark, n_shingles, component_id, kept, root for every row of ``docs``.

    ``root`` names the component whatever the ids are; it is null for an empty set.
    """
    rows = land(described(docs, width, percent), "described")
    classes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_mark")).alias("of"), F.first("n_shingles").alias("n"),
        F.first("buckets").alias("buckets"), F.first("signature").alias("signature"), F.min("doc_id").alias("low_id"),
    )
    n = rows.count()  # what follows grows with the classes, of which there are n at most
    classes = land(classes, "classes", 2 * n)

    spread = classes.select("node", F.explode("buckets").alias("bucket"))
    company = spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    entries = land(spread.join(company, "bucket"), "entries", 4 * n)
    weight = entries.groupBy("node").agg(F.sum("size").alias("weight"))
    heavy = entries.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("hub"))
    facts = land(classes.join(weight, "node").select("node", "of.*", "n", "signature"), "facts", n)
    sets = land(set_table(docs, facts, width), "sets", 20 * n)

    hubs = entries.join(heavy.select("bucket", F.col("hub.node").alias("hub")), "bucket").filter("node != hub")
    star = hubs.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    a, b = facts.select(F.col("node").alias("a"), F.struct("n", "signature").alias("l")), facts.select(F.col("node").alias("b"), F.struct("n", "signature").alias("r"))
    likely = _agree("l", "r", percent) & _may_link(F.least("l.n", "r.n"), F.greatest("l.n", "r.n"), percent)
    links = land(confirmed(star.join(a, "a").join(b, "b").filter(likely).select("a", "b"), sets, percent), "star_links", 20 * n)

    rest = land(confirmed(_between(entries, facts, sets, components(links, n), percent, n), sets, percent), "more_links", 20 * n)
    roots = components(links.union(rest), n)
    named = classes.select("node", "low_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    found = land(named.join(lowest, "root").select("node", "component_id", "root"), "components", n)
    out = rows.select("doc_id", "text_mark", "n_shingles", "node").join(found, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_mark", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root")


def _between(entries: DataFrame, facts: DataFrame, sets: DataFrame, roots: DataFrame, percent: int, n: int) -> DataFrame:
    """Pairs of a bucket in different components that no bound rules out; ``n`` is about how many classes there are."""
    placed = entries.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_rows = land(placed.join(mixed.select("bucket"), "bucket"), "open", 4 * n)
    nodes = open_rows.select("node").distinct()

    # Elements that one open class alone has: an aggregation over marks, whatever the number of classes.
    numbered = land(nodes.withColumn("owner", F.monotonically_increasing_id()), "owners", n)
    spread = lambda owners: sets.join(owners, "node").select(*(c for c in owners.columns if c != "node"), F.explode("elements").alias("mark"))
    held = land(spread(numbered).groupBy("mark").agg(F.count("*").alias("holders"), F.min("owner").alias("owner")), "holders", 60 * n)
    lone = held.filter("holders = 1").groupBy("owner").agg(F.count("*").alias("lone"))
    bounded = numbered.join(lone, "owner", "left").join(facts.select("node", "n", "signature"), "node")
    bounded = bounded.withColumn("shared", F.col("n") - F.coalesce("lone", F.lit(0))).filter(_may_link(F.col("shared"), F.col("n"), percent))
    bounded = land(bounded.join(open_rows.select("node", "root").distinct(), "node").select("node", "owner", "root", "n", "shared", "signature"), "bounded", n)

    # The rarest shareable elements of each set, so many that similar sets have one of them in common.
    first = F.col("shared") - F.floor((percent * F.col("n") + 99) / 100) + 1
    rare = spread(bounded.select("node", "owner", first.alias("first"))).join(held.filter("holders > 1").select("mark", "holders"), "mark")
    place = F.row_number().over(Window.partitionBy("owner").orderBy("holders", "mark"))
    rare = rare.withColumn("place", place).filter(F.col("place") <= F.col("first")).select("owner", "mark", "place")
    rows = land(rare.join(bounded.select("owner", "root", "n", "shared", "signature"), "owner"), "rare", 20 * n)

    left, right = rows.alias("l"), rows.alias("r")
    # Where a mark is the first that two sets share, they share no more than what either has from there on.
    most = F.least(*(F.col(f"{side}.shared") - F.col(f"{side}.place") + 1 for side in "lr"))
    same = (
        (F.col("l.mark") == F.col("r.mark")) & (F.col("l.owner") > F.col("r.owner")) & (F.col("l.root") != F.col("r.root"))
        & (100 * most >= percent * (F.col("l.n") + F.col("r.n") - most)) & _agree("l", "r", percent)
    )
    pairs = left.join(right, same).select(F.col("l.owner").alias("l"), F.col("r.owner").alias("r")).distinct()
    names = bounded.select("owner", "node")
    for side, end in (("l", "a"), ("r", "b")):
        pairs = pairs.join(names.select(F.col("owner").alias(side), F.col("node").alias(end)), side)
    return pairs.select("a", "b")


def op2_minhash_near_dedup(docs: DataFrame) -> DataFrame:
    """Every document with its shingle count, its component and whether it is the one that stays."""
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
