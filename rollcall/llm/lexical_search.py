"""Ranked lexical search over a length-stratified index (operator 12).

Method. The index is cut into segments of a bounded amount of text. In a segment documents are numbered by length,
so those of one normaliser m, a stratum, stand side by side whatever m becomes when the corpus grows;
a term's postings run by stratum and, within it, by tf. The index holds lengths and not m: a new
segment changes the corpus counts, and no earlier one has to be written again.

A search makes groups of a segment and a block of items, with the postings of the block's terms only. There the impact of
a term, (10^9 tf) div (1000 tf + 8 m), is computed once per stratum and tf. The bound of a stratum for an item is the
sum over its terms of weight times the largest impact there. Strata are visited by falling bound, twice as
many documents each time, until the bound of the next lies below the k-th best score so far; strata left out hold no
document that could enter or tie. The k best of each segment are at most k rows per item, cut to k per
task before they meet.

The index is one table in the folder of intermediate tables: a row per segment and term (local numbers and tf
as lists) and one row per segment with its ids and lengths. Counts of documents per term are summed from it over
all segments, for the terms asked for. Terms go to the postings by broadcast up to
``BROADCAST_TERMS``, by a shuffle beyond it.

Defined cases: a null text has no terms; documents and items without terms are not ranked. A document row is a
document of its own, also if it repeats an id; equal scores go by id, null ids last. Repeated
item rows (id and text) are one item; rows of one id with different texts are ranked each on its own. Fewer than k
documents above 0: all of them. Scores are exact 64-bit integers; where a float could not hold an item's largest
possible sum they are added up as integers. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.storage import land

#: Bytes that stand in no term (ASCII but digits and letters) become spaces, A-Z small letters.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Bytes of text and documents from which a segment is closed.
SEGMENT_BYTES, SEGMENT_DOCS = 8 << 20, 1 << 15
ITEM_BLOCK = 256
BROADCAST_TERMS = 100_000
K = 10
_EXACT = float(1 << 53)

_INDEX = "segment long, term string, df int, docs array<int>, tfs array<int>, ids array<long>, lengths array<long>"
_HITS = "item long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split()


class _Segment:
    """Texts that become the rows of one segment."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.found: list[pa.Array] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = terms(text)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.bytes += len(text)
        if words:
            self.found.append(pa.array(words, pa.binary()))

    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or len(self.ids) >= SEGMENT_DOCS

    def rows(self, number: int) -> pa.RecordBatch:
        """A row per term by number, its postings by length, tf and document; a last row without a term for ids and lengths."""
        lengths, n = np.array(self.lengths, np.int64), len(self.ids)
        missing = np.array([i is None for i in self.ids], bool)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        order = np.lexsort((ids, missing, lengths))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        words = pa.chunked_array(self.found, pa.binary()).combine_chunks().dictionary_encode()
        words = words if isinstance(words, pa.Array) else words.combine_chunks()
        # One number per term and document, so that equal ones are counted by sorting.
        pairs, tf = np.unique(words.indices.to_numpy().astype(np.int64) * n + np.repeat(place, lengths), return_counts=True)
        term, doc = pairs // n, pairs % n
        by = np.lexsort((doc, tf, lengths[order][doc], term))
        term, doc, tf = term[by], doc[by], tf[by]
        df = np.bincount(term, minlength=len(words.dictionary))
        ends = np.concatenate([[0], np.cumsum(df), [len(term)]]).astype(np.int32)
        directory = np.concatenate([np.zeros(len(df) + 1, np.int32), [n]]).astype(np.int32)
        named = pa.concat_arrays([words.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
        listed = pa.ListArray.from_arrays
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(named), number, np.int64)), named, pa.array(np.append(df, 0).astype(np.int32)),
                listed(pa.array(ends), pa.array(doc.astype(np.int32))), listed(pa.array(ends), pa.array(tf.astype(np.int32))),
                listed(pa.array(directory), pa.array(ids[order], mask=missing[order])), listed(pa.array(directory), pa.array(lengths[order])),
            ],
            names=["segment", "term", "df", "docs", "tfs", "ids", "lengths"],
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, segment = TaskContext.get().partitionId() << 32, _Segment()
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            segment.add(doc_id, text.as_py() or b"")
            if segment.full():
                yield from _parts(segment.rows(number))
                number, segment = number + 1, _Segment()
    if segment.ids:
        yield from _parts(segment.rows(number))


def _parts(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, 4096):
        yield rows.slice(at, 4096)


def build(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written once: rows with a term are postings, those without one a segment's documents."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_segments, _INDEX)
    return land(found, "postings")


def corpus_counts(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    own = index.filter("term IS NULL").select(F.filter("lengths", lambda n: n > 0).alias("lengths"))
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
    n, total = own.agg(F.sum(F.size("lengths").cast("long")), F.sum(size)).first()
    return n or 0, total or 0


def asked(items: DataFrame) -> DataFrame:
    """item (a number), item_id and terms of every item row that has terms, repeated rows once."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[t.decode() for t in sorted(set(terms((text or "").encode())))] for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    rows = rows.mapInArrow(split, "item_id long, terms array<string>").filter(F.size("terms") > 0)
    return land(rows.withColumn("item", F.monotonically_increasing_id()), "items")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Postings:
    """A segment's postings of some terms (numbers, ascending), cut into strata by m."""

    def __init__(self, lengths: np.ndarray, term: np.ndarray, docs: np.ndarray, tf: np.ndarray, counts: tuple[int, int]) -> None:
        n, total = counts
        if 90 * int(lengths.max(initial=0)) * n < 1 << 63:
            m = 10 + 90 * lengths * n // total
        else:
            m = np.array([10 + 90 * int(x) * n // total for x in lengths], np.int64)
        self.strata = np.append(np.flatnonzero(np.diff(m, prepend=m[0] - 1)), len(m))  # first document of each, and the end
        stratum = np.repeat(np.arange(len(self.strata) - 1), np.diff(self.strata))[docs]
        new_entry = (np.diff(term, prepend=-1) != 0) | (np.diff(stratum, prepend=-1) != 0)
        # Neighbours of one stratum and tf share one impact.
        first = np.flatnonzero(new_entry | (np.diff(tf, prepend=-1) != 0))
        impact = 1_000_000_000 * tf[first] // (1000 * tf[first] + 8 * m[docs[first]])
        self.docs, self.impact = docs, np.repeat(impact, np.diff(np.append(first, len(docs))))
        # An entry is a term in a stratum; its postings run by tf, so the last one has the largest impact.
        self.start = np.flatnonzero(new_entry)
        self.end = np.append(self.start[1:], len(docs))
        self.term, self.stratum, self.most = term[self.start], stratum[self.start], self.impact[self.end - 1]


def best(postings: Postings, entries: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the documents with the ``k`` highest scores above 0, all that tie with the last included.

    ``entries``: the entries of an item's terms, with the ``weights`` of their terms.
    """
    stratum, strata = postings.stratum[entries], postings.strata
    bounds = np.bincount(stratum, weights * postings.most[entries].astype(float), len(strata) - 1)
    exact = bounds.max() < _EXACT
    if not exact:
        bounds = np.where(bounds > 0, np.inf, 0)
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > 0]
    sizes = np.cumsum(np.diff(strata)[order])
    scores = np.zeros(strata[-1], float if exact else np.int64)
    done, wanted = 0, 4 * k
    while done < len(order):
        upto = max(done + 1, int(np.searchsorted(sizes, wanted)) + 1)
        now = np.zeros(len(bounds), bool)
        now[order[done:upto]] = True
        chosen = now[stratum]
        starts, ends = postings.start[entries[chosen]], postings.end[entries[chosen]]
        run = _ranges(starts, ends)
        gain = postings.impact[run] * np.repeat(weights[chosen], ends - starts)
        if exact:
            scores += np.bincount(postings.docs[run], gain, len(scores))
        else:
            np.add.at(scores, postings.docs[run], gain)
        done, wanted = upto, wanted * 2
        if done < len(order) and len(scores) >= k and bounds[order[done]] < np.partition(scores, len(scores) - k)[len(scores) - k]:
            break
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
    return found, scores[found].astype(np.int64)


def _search(counts: tuple[int, int], k: int):
    def search(group: pa.Table) -> pa.Table:
        directory = group.filter(pc.is_null(group["term"])).combine_chunks()
        rows = group.filter(pc.is_valid(group["term"])).combine_chunks()
        hits: list[tuple] = []
        if rows.num_rows:
            lists = {c: rows[c].combine_chunks() for c in ("docs", "tfs", "items")}
            flat = {c: x.flatten().to_numpy().astype(np.int64) for c, x in lists.items()}
            number = np.arange(rows.num_rows)
            repeated = {c: np.repeat(number, pc.list_value_length(x).to_numpy()) for c, x in lists.items()}
            lengths = directory["lengths"].combine_chunks().flatten().to_numpy()
            ids = directory["ids"].combine_chunks().flatten()
            missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            postings = Postings(lengths, repeated["docs"], flat["docs"], flat["tfs"], counts)
            weights, entry_of = rows["weight"].to_numpy().astype(np.int64), np.searchsorted(postings.term, np.arange(rows.num_rows + 1))
            by = np.argsort(flat["items"], kind="stable")
            items, owned = flat["items"][by], repeated["items"][by]
            for at in np.split(np.arange(len(by)), np.flatnonzero(np.diff(items)) + 1):
                own = owned[at]
                starts, ends = entry_of[own], entry_of[own + 1]
                found, scores = best(postings, _ranges(starts, ends), np.repeat(weights[own], ends - starts), k) if weights[own].any() else ([], [])
                if len(found):
                    # The k first by score, then id, null ids last.
                    first = np.lexsort((ids[found], missing[found], -scores))[:k]
                    hits.append((np.full(len(first), items[at[0]]), ids[found][first], missing[found][first], scores[first]))
        item, doc, missing, score = (np.concatenate(x) for x in zip(*hits, strict=True)) if hits else (np.zeros(0, np.int64),) * 4
        return pa.table({"item": pa.array(item, pa.int64()), "doc_id": pa.array(doc, pa.int64(), mask=missing.astype(bool)), "score": pa.array(score, pa.int64())})

    return search


def search(index: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of the index for every row of ``items`` (item_id, text)."""
    counts = corpus_counts(index)
    queries = asked(items)
    n_items = queries.count()
    blocks = max(1, -(-n_items // ITEM_BLOCK))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    wanted = queries.select("item", block, F.explode("terms").alias("term")).groupBy("block", "term").agg(F.collect_list("item").alias("items"))
    wanted = land(wanted, "terms")
    small = wanted.count() <= BROADCAST_TERMS
    sent = F.broadcast if small else lambda rows: rows

    postings = index.filter("term IS NOT NULL")
    df = postings.select("term", "df").join(sent(wanted.select("term").distinct()), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * counts[0] + 2)) / (2 * F.col("df") + 1).cast("double")))
    wanted = land(wanted.join(df.select("term", weight.alias("weight")), "term"), "weights")

    told = postings.select("segment", "term", "docs", "tfs").join(sent(wanted), "term").select("block", "segment", "term", "docs", "tfs", "weight", "items")
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in [*told.dtypes, ("ids", "array<long>"), ("lengths", "array<long>")]}
    told = told.select("*", nothing["ids"], nothing["lengths"])
    own = index.filter("term IS NULL").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "segment", "ids", "lengths")
    own = own.select("block", "segment", *(nothing[c] for c in ("term", "docs", "tfs", "weight", "items")), "ids", "lengths")
    hits = told.unionByName(own).groupBy("block", "segment").applyInArrow(_search(counts, k), _HITS)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    hits = hits.withColumn("rank", place).filter(F.col("rank") <= k)
    return hits.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best of whole ``docs`` for every item."""
    return search(build(docs.select("doc_id", "text")), items)
