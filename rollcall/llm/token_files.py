"""Token ids in compressed files (operator 4).

Method: static range asymmetric numeral system. Documents are dealt by ranges of their id, encoded by
the tokenizer and gathered into segments of whole documents. A segment has one table of frequencies,
shared by its blocks. Each block of ``BLOCK`` ids is coded by ``LANES`` interleaved coders on their own,
with the coders' states kept at its start and every ``CHECKPOINT`` steps, and a checksum of its ids, so
blocks, and parts of a block, can be decoded independently.

Format: one row per segment in Parquet files that Spark writes and reads. Integers are little-endian.

* ``part``, ``number``: the range of ids and the segment's place in it; ``before``: ids of the part
  before the segment; ``n_ids``; ``doc_ids``, ``lengths``: its documents in order, with the end id;
* ``symbols`` (uint32) and ``frequencies`` (uint32, sum 2^20): the shared table;
* ``blocks``: for each block its ids' count, CRC-32, checkpoints (states uint64, one per lane and
  checkpoint; places in the words) and words (uint32).

A part is ordered by id and by ``text_mark`` among equal ids; null ids come first. Null and blank texts
have the end id alone. Rows that repeat id and text are written as often as they stand there. An empty
table gives no segments. A document is never split over segments, so a segment is as long as its longest
document where that is longer than ``SEGMENT``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.keys import marked
from rollcall.llm.tokens import encoder
from rollcall.storage import land

END_ID = 2
#: Ids in a segment (at least, but for the last of a part), in a block; coders of a block; steps between checkpoints.
SEGMENT, BLOCK, LANES, CHECKPOINT = 1 << 20, 1 << 16, 256, 64
#: Frequencies of a table add up to 2^PRECISION; states stay at or above LOW and give up 32 bits at a time.
PRECISION, LOW = 20, np.uint64(1 << 31)
_P, _MASK, _32 = np.uint64(PRECISION), np.uint64((1 << PRECISION) - 1), np.uint64(32)

_BLOCK = "struct<n_ids:int,crc32:long,states:binary,places:binary,words:binary>"
SCHEMA = (
    "part int, number int, before long, n_ids long, doc_ids array<long>, lengths array<long>, "
    f"symbols binary, frequencies binary, blocks array<{_BLOCK}>"
)


def table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of ``ids`` in order and whole frequencies, none below 1, that add up to 2^PRECISION."""
    every = np.bincount(ids)
    symbols, total = np.flatnonzero(every), 1 << PRECISION
    counts = every[symbols]
    if len(symbols) > total:
        raise ValueError("more symbols than a table can hold")
    scaled = np.maximum(1, counts * total // counts.sum())
    over = int(scaled.sum()) - total
    for k in np.argsort(-scaled, kind="stable"):  # the largest carry what rounding left over
        if over <= 0:
            break
        take = min(over, int(scaled[k]) - 1)
        scaled[k] -= take
        over -= take
    if over < 0:
        scaled[np.argmax(scaled)] -= over
    return symbols, scaled.astype(np.uint64)


def encode_blocks(ids: np.ndarray, symbols: np.ndarray, frequencies: np.ndarray) -> list[dict]:
    """All blocks of a segment at once: lane l of block b codes the ids l, l + LANES, ... of that block."""
    n_blocks = -(-len(ids) // BLOCK)
    steps = BLOCK // LANES if n_blocks > 1 else -(-len(ids) // LANES)
    place = np.zeros(n_blocks * steps * LANES, np.int64)
    known = np.zeros(int(symbols[-1]) + 1, np.int64)
    known[symbols] = np.arange(len(symbols))
    place[: len(ids)] = known[ids]  # what is missing in the last block is filled with the first symbol
    place = place.reshape(n_blocks, steps, LANES)
    starts = np.cumsum(frequencies) - frequencies
    state = np.full((n_blocks, LANES), LOW, np.uint64)
    words, emitted = np.zeros((n_blocks, steps, LANES), np.uint32), np.zeros((n_blocks, steps, LANES), bool)
    kept = {}
    for step in range(steps - 1, -1, -1):
        at = place[:, step]
        frequency = frequencies[at]
        full = state >= frequency << np.uint64(63 - PRECISION)
        words[:, step], emitted[:, step] = state & np.uint64(0xFFFFFFFF), full
        state = np.where(full, state >> _32, state)
        whole = state // frequency
        state = (whole << _P) + (state - whole * frequency) + starts[at]
        if step % CHECKPOINT == 0:
            kept[step] = state
    marks = sorted(kept)
    blocks = []
    for b in range(n_blocks):
        own = ids[b * BLOCK : (b + 1) * BLOCK]
        places = np.concatenate([[0], np.cumsum(emitted[b].sum(1))])[marks]
        blocks.append({
            "n_ids": len(own), "crc32": zlib.crc32(own.astype("<u4").tobytes()),
            "states": np.stack([kept[m][b] for m in marks]).astype("<u8").tobytes(),
            "places": places.astype("<u4").tobytes(), "words": words[b][emitted[b]].astype("<u4").tobytes(),
        })
    return blocks


def decode_blocks(blocks: list[dict], symbols: np.ndarray, frequencies: np.ndarray, first: int = 0, last: int | None = None) -> list[np.ndarray]:
    """The ids of each block, all decoded side by side, or only those from checkpoint ``first`` up to checkpoint ``last``."""
    slots, starts = slot_table(frequencies), np.cumsum(frequencies) - frequencies
    begin = first * CHECKPOINT
    stop = min(max(-(-b["n_ids"] // LANES) for b in blocks), begin + BLOCK if last is None else last * CHECKPOINT)
    # A block that ends before its checkpoint has no state there and nothing to give.
    going = [k for k, b in enumerate(blocks) if b["n_ids"] > begin * LANES]
    if not going:
        return [np.empty(0, np.uint32) for _ in blocks]
    words = np.frombuffer(b"".join(blocks[k]["words"] + bytes(4 * LANES) for k in going), "<u4").astype(np.uint64)
    sizes = np.array([len(blocks[k]["words"]) // 4 + LANES for k in going], np.int64)
    at = np.cumsum(sizes) - sizes + [int(np.frombuffer(blocks[k]["places"], "<u4")[first]) for k in going]
    most = np.cumsum(sizes) - 1
    state = np.stack([np.frombuffer(blocks[k]["states"], "<u8").reshape(-1, LANES)[first] for k in going])
    out = np.zeros((len(going), stop - begin, LANES), np.uint32)
    for step in range(begin, stop):
        slot = state & _MASK
        found = slots[slot]
        out[:, step - begin] = symbols[found]
        state = frequencies[found] * (state >> _P) + slot - starts[found]
        low = state < LOW
        taken = np.cumsum(low, axis=1)
        place = np.minimum(at[:, None] + taken - 1, most[:, None])  # a block that is over reads zeros behind its words
        state[low] = state[low] << _32 | words[place[low]]
        at += taken[:, -1]
    given = dict(zip(going, out, strict=True))
    return [given[k].reshape(-1)[: max(0, b["n_ids"] - begin * LANES)] if k in given else np.empty(0, np.uint32) for k, b in enumerate(blocks)]


def slot_table(frequencies: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(frequencies)), frequencies.astype(np.int64))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode whole texts of ``docs`` and write the segments to ``path``, which all executors reach."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def segment(part: int, number: int, before: int, names: list, ids: list[bytes]) -> dict:
        joined = np.frombuffer(b"".join(ids), "<u4")
        symbols, frequencies = table(joined)
        return {
            "part": part, "number": number, "before": before, "n_ids": len(joined), "doc_ids": names, "lengths": [len(i) // 4 for i in ids],
            "symbols": symbols.astype("<u4").tobytes(), "frequencies": frequencies.astype("<u4").tobytes(),
            "blocks": encode_blocks(joined, symbols, frequencies),
        }

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_to_ids, part, number, before, held, names, ids = encoder(tokenizer_path).encode, 0, 0, 0, 0, [], []
        for batch in batches:
            for part, doc, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_to_ids(batch.column(2)), strict=True):
                ids.append(own + end)
                names.append(doc)
                held += len(ids[-1]) // 4
                if held >= SEGMENT:
                    yield pa.RecordBatch.from_pylist([segment(part, number, before, names, ids)], _ARROW)
                    number, before, held, names, ids = number + 1, before + held, 0, [], []
        if ids:
            yield pa.RecordBatch.from_pylist([segment(part, number, before, names, ids)], _ARROW)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = marked(docs).repartitionByRange(parts, F.col("doc_id"), F.col("text_mark")).sortWithinPartitions("doc_id", "text_mark")
    dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(encode, SCHEMA).write.parquet(path)


_ARROW = pa.schema([
    ("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("symbols", pa.binary()), ("frequencies", pa.binary()),
    ("blocks", pa.list_(pa.struct([("n_ids", pa.int32()), ("crc32", pa.int64()), ("states", pa.binary()), ("places", pa.binary()), ("words", pa.binary())]))),
])


def decode_segment(row: dict) -> np.ndarray:
    """All ids of a segment; a block whose checksum differs is an error."""
    symbols, frequencies = np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["frequencies"], "<u4").astype(np.uint64)
    out = decode_blocks(row["blocks"], symbols, frequencies)
    for k, (ids, block) in enumerate(zip(out, row["blocks"], strict=True)):
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["crc32"]:
            raise ValueError(f"part {row['part']}, segment {row['number']}, block {k}: checksum differs")
    return np.concatenate(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, at (place in its part), n_tokens, ids_crc32, ids of every document in the files at ``path``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                data = decode_segment(row).astype("<u4").tobytes()
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), row["lengths"], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(ids), pa.int32()),
                    pa.array(row["before"] + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                ], names=["doc_id", "part", "at", "n_tokens", "ids_crc32", "ids"])

    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(decode, "doc_id long, part int, at long, n_tokens long, ids_crc32 long, ids binary")


def op4_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the files, read them back, and describe each document: doc_id, start, n_tokens, ids_crc32."""
    write(docs, path, tokenizer_path, end_id)
    spark = docs.sparkSession
    # One row per part: the window over them is as short as the list of files.
    parts = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = land(parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset")), "offsets")
    found = read(spark, path).drop("ids")
    return found.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
