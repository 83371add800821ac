"""Packing documents into fixed-length sequences (operator 10).

Method: non-negative least squares over packing patterns. Pieces of documents are counted by length;
patterns of two or three lengths that fill a sequence exactly get repeat counts by a non-negative fit
to that histogram; the counts are rounded to whole numbers that the histogram can supply, and what is
left is packed best-fit, longest first, into new sequences.

The plan works on counts of lengths: at most ``capacity`` numbers whatever the size of the corpus, the
only thing that reaches the driver. Pieces take their places by their rank among the pieces of their
length. Ranks come from counts per slice of pieces and a running number within a slice, so that a
length that a third of all pieces have is spread over many tasks.

Defined cases: null and empty texts give one piece that holds the end id alone. Equal lengths are
ranked by slice, id, text mark and piece. Rows that repeat id and text are packed as often as they stand there. An empty
table gives an empty result. Only documents longer than a sequence are cut.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.keys import marked
from rollcall.llm.tokens import encoder
from rollcall.storage import land

CAPACITY, END_ID = 2048, 0
#: Passes of the coordinate descent over all patterns.
SWEEPS = 4

_PIECES = "doc_id long, text_mark long, piece int, start long, length long, ids_crc32 long, ids binary"
_NAMES = ["doc_id", "text_mark", "piece", "start", "length", "ids_crc32", "ids"]
_ARROW = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, kept_words: int | None = None) -> DataFrame:
    """Each document's ids with ``end_id`` behind them, cut only where they are longer than ``capacity``.

    ``kept_words`` bounds the words a worker remembers; it changes no result.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, kept_words).encode
        for batch in batches:
            rows = []
            for doc, mark, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encode(batch.column(2)), strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, mark, number, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ARROW)], names=_NAMES)

    made = marked(docs).mapInArrow(cut, _PIECES)
    return made if with_ids else made.drop("ids")


def patterns(lengths: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Pairs and triples of lengths that occur and fill a sequence exactly, and single full pieces."""
    there = set(lengths.tolist())
    found: list[tuple[int, ...]] = [(capacity,)] if capacity in there else []
    found += [(capacity - a, a) for a in sorted(there) if 2 * a <= capacity and capacity - a in there]
    ordered = sorted(there, reverse=True)
    for big in ordered:
        rest = capacity - big
        if big * 3 < capacity:
            break
        found += [(big, rest - c, c) for c in sorted(there) if 2 * c <= rest and rest - c <= big and rest - c in there]
    return found


def fit(histogram: np.ndarray, chosen: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that lessen |Ax - histogram|^2, by coordinate descent; A counts lengths in patterns."""
    left, counts = histogram.astype(float).tolist(), [0.0] * len(chosen)
    shapes = [(tuple((n, p.count(n)) for n in sorted(set(p))), sum(p.count(n) ** 2 for n in set(p))) for p in chosen]
    for _ in range(sweeps):
        for k, (parts, norm) in enumerate(shapes):
            step = sum(left[n] * m for n, m in parts) / norm
            step = max(step, -counts[k])
            if step:
                counts[k] += step
                for n, m in parts:
                    left[n] -= step * m
    return np.array(counts)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the histogram exactly."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    made: list[tuple[tuple[int, ...], int]] = []
    chosen = patterns(np.flatnonzero(left), capacity)
    wanted = fit(left, chosen)
    for k in np.argsort(-wanted, kind="stable"):
        if wanted[k] < 0.5:
            break
        count = min(int(round(wanted[k])), *(int(left[n]) // chosen[k].count(n) for n in chosen[k]))
        if count > 0:
            made.append((chosen[k], count))
            for n in chosen[k]:
                left[n] -= count
    return made + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: pieces of one length go to sequences of one filling together."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def add(room: int, filled: tuple[int, ...], count: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append([filled, count])

    for length in range(capacity, 0, -1):
        todo = int(left[length])
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if todo >= each:
                    add(capacity - each * length, (length,) * each, todo // each)
                    todo %= each
                else:
                    add(capacity - todo * length, (length,) * todo, 1)
                    todo = 0
                continue
            room = rooms[at]
            filled, count = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room], rooms[at]
            each = min(room // length, todo)
            used = min(count, todo // each)
            if used < count:
                add(room, filled, count - used)
            add(room - each * length, filled + (length,) * each, used)
            todo -= each * used
    return [(filled, count) for room in sorted(open_by_room) for filled, count in open_by_room[room]]


def _slots(made: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, where the ranks of a pattern's place begin, and that place's first sequence and offset."""
    by_length: dict[int, list[tuple[int, int]]] = {}
    sequence = 0
    for lengths, count in made:
        offset = 0
        for n in lengths:
            by_length.setdefault(n, []).append((count, sequence, offset))
            offset += n
        sequence += count
    out = {}
    for n, places in by_length.items():
        counts, firsts, offsets = map(np.array, zip(*places, strict=True))
        out[n] = (np.cumsum(counts) - counts, firsts, offsets)
    return out


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``, from 0 among the pieces of one length, without a task that holds one length."""
    slices = parts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sliced = parts.withColumn("slice", F.pmod(F.xxhash64("text_mark", "doc_id", "piece"), F.lit(4 * int(slices))))
    counts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    # One row per length and slice; a window over a length's slices.
    before = counts.select(
        "length", "slice", (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("before")
    )
    own = Window.partitionBy("length", "slice").orderBy("doc_id", "text_mark", "piece")
    return (
        sliced.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("own"))
        .drop("slice", "own", "before")
    )


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``parts`` is read twice, so give a written table."""
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = parts.sparkSession.sparkContext.broadcast(_slots(plan(histogram, capacity)))
    numbered = ranked(parts)
    schema = T.StructType([*numbered.drop("rank").schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = places.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                begins, firsts, offsets = slots[int(n)]
                mine = np.flatnonzero(length == n)
                at = np.searchsorted(begins, rank[mine], side="right") - 1
                sequence[mine] = firsts[at] + rank[mine] - begins[at]
                offset[mine] = offsets[at]
            kept = [batch.column(n) for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=schema.names)

    return numbered.mapInArrow(seat, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves: one row per sequence, pieces in place, from ``pieces(with_ids=True)``.

    A sequence holds at most its capacity in ids, which bounds the group.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts"), F.sum("length").alias("length"))


def op10_best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, kept_words: int | None = None) -> DataFrame:
    """One row per piece with its sequence and place there."""
    parts = land(pieces(docs, tokenizer_path, capacity, end_id, kept_words=kept_words), "pieces")
    return pack(parts, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
