"""Removal of word sequences that stand more than once (operator 7).

Method: level-wise doubling. A window is a number of consecutive words of one document. Windows of the
first length are named by a hash of their words and counted over the whole corpus; those that stand once
are dropped. A window of twice the length is named by the pair of names of its two halves, so only a
window whose halves are both repeated is a candidate at the next level, and the text is not read again.
Levels go on, the last one shortened to the wanted length (its halves then overlap), until no candidates
survive or that length is reached. Names have 44 bits of a hash at the first level and 64 at the later
ones, where a name stands for a pair of names of the level before.

Asking whether a name stands elsewhere is a shuffle of packed numbers: documents are gathered into chunks
of at most ``CHUNK`` words (or one longer document); a chunk sends the names that occur in it, once
each, sorted, to the bucket of the name; the bucket answers with those that another chunk has too. What
a chunk has twice itself needs no answer. So a window that very many documents share is sent once per
chunk, and no bucket, chunk or pair list grows with it.

Defined cases: null texts have no words; documents shorter than a window lose nothing. Rows that repeat id and
text are further places of their windows, and all of them lose the same words. Only the windows of the input
count, whatever is left of them. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.keys import marked
from rollcall.storage import land

#: Words in a window of the last and of the first level.
WIDTH, FIRST = 35, 18
#: Words gathered into one chunk; names in one bucket, about.
CHUNK, BUCKET = 1_000_000, 2_000_000
#: Bits of a name that go to a bucket at the first level, where each position of the corpus is asked.
BITS = 44

_ROWS = "chunk long, bucket int, kind int, data binary"
_ASK, _DOCS, _HELD = 0, 1, 2
_STEPS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def levels(width: int = WIDTH, first: int = FIRST) -> list[int]:
    """``first``, doubled until it reaches ``width``, which is the last one."""
    out = [min(first, width)]
    while out[-1] < width:
        out.append(min(2 * out[-1], width))
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_names(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words; none if there are fewer."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    marks = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    sums = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        sums += marks[k : len(marks) - width + 1 + k] * _STEPS[k]
    return _spread(sums)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, lowest bytes first, so that the shuffle's compression finds the empty high ones."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _pack(rising: np.ndarray, other: np.ndarray) -> bytes:
    """Two columns of numbers, the first of them rising."""
    return _planes(np.diff(rising.astype(np.uint64), prepend=np.uint64(0))) + _planes(other.astype(np.uint64))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.cumsum(_numbers(data[:half]), dtype=np.uint64), _numbers(data[half:])


def _rows(chunk: int, place: np.ndarray, name: np.ndarray, buckets: int, bits: int, docs: bytes) -> list[tuple]:
    """What a chunk sends: asks to the buckets of its names, and to itself its documents and what is repeated for certain.

    A name that the chunk has twice needs no answer, but others have to hear of it: it is sent with place 0.
    All other places are sent plus 1. Rows to itself pass through any bucket.
    """
    order = np.argsort(name, kind="stable")
    name, place = name[order], place[order]
    fresh = np.ones(len(name), bool)
    fresh[1:] = name[1:] != name[:-1]
    twice = ~fresh
    twice[:-1] |= ~fresh[1:]
    through = chunk % buckets
    out = [(chunk, through, _DOCS, docs)]
    if twice.any():
        own = np.argsort(place[twice])
        out.append((chunk, through, _HELD, _pack(place[twice][own], name[twice][own])))
    asked, at = name[fresh], np.where(twice, 0, place + 1)[fresh]
    bucket = (asked >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        out.append((chunk, b, _ASK, _pack(asked[edges[b] : edges[b + 1]], at[edges[b] : edges[b + 1]])))
    return out


def _frame(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["chunk", "bucket", "kind", "data"])


def _first_level(buckets: int, width: int):
    """Whole texts to chunks and their asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held, part, number = 0, None, 0
        names: list[np.ndarray] = []
        places: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = (part << 32) | number
            docs = pa.RecordBatch.from_arrays([pa.array([i[k] for i in ids], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "text_mark", "n_words", "digest"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema) as writer:
                writer.write_batch(docs)
            place, name = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((places, np.int64), (names, np.uint64)))
            for row in _rows(chunk, place, name >> np.uint64(64 - BITS), buckets, BITS, sink.getvalue().to_pybytes()):
                yield _frame([row])

        for batch in batches:
            for own, doc, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = own
                words = text.encode().split()
                name = window_names(words, width)
                if len(name):
                    names.append(name)
                    places.append(held + np.arange(len(name)))
                ids.append((doc, mark, len(words), hashlib.sha256(b" ".join(words)).digest()))
                held += len(words) + 1  # a gap, so that halves that touch are of one document
                if held >= CHUNK:
                    yield from flush()
                    ids, names, places, held, number = [], [], [], 0, number + 1
        if ids:
            yield from flush()

    return run


def _answer(last: bool):
    """A bucket: names that more than one chunk sent go back to the chunks that wait, with their places."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ask = rows["kind"] == _ASK
        through = rows[~ask]
        asks = [(c, *_unpack(d)) for c, d in zip(rows["chunk"][ask], rows["data"][ask], strict=True)]
        out = []
        if asks:
            sent = np.concatenate([a[1] for a in asks])
            sent.sort(kind="stable")
            repeated = np.unique(sent[1:][sent[1:] == sent[:-1]])
            del sent
            for chunk, name, place in asks:
                at = np.searchsorted(repeated, name)
                hit = (place > 0) & (at < len(repeated))
                hit[hit] = repeated[at[hit]] == name[hit]
                if hit.any():
                    own = np.argsort(place[hit])
                    named = np.zeros(len(own), np.uint64) if last else name[hit][own]  # after the last level places are enough
                    out.append((chunk, 0, _HELD, _pack(place[hit][own] - np.uint64(1), named)))
        return pd.concat([through, pd.DataFrame(out, columns=rows.columns)]) if out else through

    return run


def _gathered(rows: pd.DataFrame) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A chunk's documents, and its repeated windows by place with their names."""
    docs = next(d for k, d in zip(rows["kind"], rows["data"], strict=True) if k == _DOCS)
    pairs = [_unpack(d) for k, d in zip(rows["kind"], rows["data"], strict=True) if k == _HELD]
    if not pairs:
        return docs, np.empty(0, np.int64), np.empty(0, np.uint64)
    place, name = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    order = np.argsort(place, kind="stable")
    return docs, place[order].astype(np.int64), name[order]


def _next_level(buckets: int, shift: int):
    """A chunk's repeated windows to windows made of two of them, ``shift`` words apart."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        docs, place, name = _gathered(rows)
        other = np.searchsorted(place, place + shift)
        there = other < len(place)
        there[there] = place[other[there]] == place[there] + shift
        # The halves touch or overlap, and places have a gap between documents, so both are of one document.
        pair = _spread(_spread(name[there]) * _STEPS[0] + name[other[there]] * _STEPS[1])
        return pd.DataFrame(_rows(int(key[0]), place[there], pair, buckets, 64, docs), columns=["chunk", "bucket", "kind", "data"])

    return run


def _covered(width: int):
    """A chunk's documents with the words that its repeated windows cover."""

    def run(rows: pa.Table) -> pa.Table:
        blob, place, _ = _gathered(rows.to_pandas())
        docs = pa.ipc.open_stream(blob).read_all()
        n_words = docs.column("n_words").to_numpy()
        begins = np.cumsum(n_words + 1) - n_words - 1
        steps = np.zeros(int(n_words.sum()) + len(n_words) + width + 1, np.int32)
        steps[place] += 1  # places differ
        np.subtract.at(steps, place + width, 1)
        gone = np.cumsum(steps) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[begins + n_words] - total[begins]
        spans = []
        for begin, n, r in zip(begins.tolist(), n_words.tolist(), removed.tolist(), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[begin : begin + n].view(np.int8), [0]]))) if r else None
            spans.append(None if edges is None else edges.astype("<i4").tobytes())
        return pa.table({
            "doc_id": docs.column("doc_id"), "text_mark": docs.column("text_mark"), "n_words": docs.column("n_words"),
            "n_removed": pa.array(removed, pa.int64()), "digest": docs.column("digest"), "spans": pa.array(spans, pa.binary()),
        })

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, first: int = FIRST) -> DataFrame:
    """doc_id, text_mark, n_words, n_removed, digest (SHA-256 of all words), spans (begins and ends of removed words).

    One row for every row of ``docs``.
    """
    lengths = levels(width, first)
    texts = marked(docs).select(F.spark_partition_id().alias("part"), "doc_id", "text_mark", "text")
    # The number of buckets follows the corpus: bytes of text, at five or six to a word.
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, round(size / 6 / BUCKET))
    rows = texts.mapInArrow(_first_level(buckets, lengths[0]), _ROWS)
    for k, length in enumerate(lengths):
        last = k + 1 == len(lengths)
        chunks = rows.groupBy("bucket").applyInPandas(_answer(last), _ROWS).groupBy("chunk")
        if not last:
            rows = chunks.applyInPandas(_next_level(buckets, lengths[k + 1] - length), _ROWS)
    schema = "doc_id long, text_mark long, n_words long, n_removed long, digest binary, spans binary"
    return chunks.applyInArrow(_covered(width), schema)


def substring_dedup(docs: DataFrame, width: int = WIDTH, first: int = FIRST) -> DataFrame:
    """doc_id, text_mark, n_words, n_removed, kept (kept words joined by one space; null where nothing went), kept_sha256."""
    spans = land(repeated_spans(docs, width, first), "spans")
    whole = spans.filter("n_removed = 0").select("doc_id", "text_mark", "n_words", "n_removed", F.lit(None).cast("string").alias("kept"), F.lower(F.hex("digest")).alias("kept_sha256"))
    cut = spans.filter("n_removed > 0").select(F.col("doc_id").alias("of_id"), F.col("text_mark").alias("of_mark"), "n_words", "n_removed", "spans")
    # Rows that repeat id and text have the same spans: one of them meets the text, and counts for all.
    cut = cut.groupBy("of_id", "of_mark").agg(*(F.first(c).alias(c) for c in ("n_words", "n_removed", "spans")))
    texts = marked(docs)
    found = texts.join(cut, texts["doc_id"].eqNullSafe(cut["of_id"]) & (texts["text_mark"] == cut["of_mark"]))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                words, edges = text.encode().split(), [0, *np.frombuffer(spans, "<i4").tolist()]
                left = [words[a:b] for a, b in zip(edges[::2], [*edges[1::2], len(words)], strict=True)]
                kept.append(b" ".join(w for some in left for w in some))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([k.decode() for k in kept]), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                names=["doc_id", "text_mark", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    schema = "doc_id long, text_mark long, n_words long, n_removed long, kept string, kept_sha256 string"
    return whole.union(found.select("doc_id", "text_mark", "n_words", "n_removed", "text", "spans").mapInArrow(keep, schema))


def op7_substring_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return substring_dedup(docs, width).select("doc_id", "n_words", "n_removed", "kept_sha256")
