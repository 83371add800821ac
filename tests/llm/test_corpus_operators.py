"""Tokens, token files, mixing, toxicity and packing against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rollcall.llm import mixing, packing, token_files, tokens, toxicity
from tokenizers import Tokenizer

from .conftest import CLASHING, ODD_ROWS


@pytest.fixture(scope="module")
def plain(tokenizer_path):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    None, "", "  a ", "a<|endoftext|>b  c", "A<|ENDOFTEXT|>B <|startoftext|>", "don't WON'T it's'll\t\n'd", "x y z\x1cq\x85w", "\x00 a\x00b",
    "a. b, c., d.. , . x.y, 's, it's. é. 1, ß,", "ÀÉ Þß ÿŸ × ÷ ª º µ ÑO, ẞ K Å ́ a ́b İ Σ ΑΣ", "日本語 テキスト 123 45", "ﬁ ½ " + "x" * 500,
    "J\u030c x", "H\u0331", "T\u0308 Q", "aW\u030a", "Y\u030a. J", "J\u030c<|endoftext|>\u030cJ", "A\u0301 E\u0301E \u0301Z",
    "".join(map(chr, range(0x20, 0x250))), " ".join(map(chr, range(0x20, 0x250))),
]


def test_words_give_the_tokenizers_ids(plain, tokenizer_path, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 20)
    monkeypatch.setattr(tokens, "SLICE", 50)
    encoder = tokens.WordEncoder(tokenizer_path)
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(pa.array(ODD_TEXTS))] == [plain(t) for t in ODD_TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_texts_give_the_tokenizers_ids(plain, tokenizer_path, texts):
    found = tokens.encoder(tokenizer_path).encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(i, "<u4").tolist() for i in found] == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAhHjJtTwWyY .\u030c\u0331\u0308\u030a\u0301", max_size=30), max_size=6))
def test_letters_with_marks_give_the_tokenizers_ids(plain, tokenizer_path, texts):
    found = tokens.encoder(tokenizer_path).encode(pa.array(texts, pa.string()))
    assert [np.frombuffer(i, "<u4").tolist() for i in found] == [plain(t) for t in texts]


@pytest.mark.parametrize(("n", "symbols"), [(1, 1), (257, 3), (65_536, 50), (65_537, 5000), (400_000, 49_000)])
def test_blocks_round_trip(n, symbols):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(20 / symbols if symbols > 20 else 0.5, n), symbols).astype(np.uint32)
    known, frequencies = token_files.table(ids)
    assert frequencies.sum() == 1 << token_files.PRECISION and frequencies.min() >= 1
    blocks = token_files.encode_blocks(ids, known, frequencies)
    out = token_files.decode_blocks(blocks, known, frequencies)
    assert (np.concatenate(out) == ids).all()
    # From a checkpoint on, and up to one.
    step = token_files.CHECKPOINT * token_files.LANES
    for first, last in ((1, None), (1, 3), (0, 1)):
        part = token_files.decode_blocks(blocks, known, frequencies, first, last)
        for whole, some in zip(out, part, strict=True):
            assert (some == whole[first * step : None if last is None else last * step]).all()


def test_a_damaged_block_is_an_error():
    ids = np.arange(3000, dtype=np.uint32) % 77
    known, frequencies = token_files.table(ids)
    blocks = token_files.encode_blocks(ids, known, frequencies)
    row = {"part": 0, "number": 0, "symbols": known.astype("<u4").tobytes(), "frequencies": frequencies.astype("<u4").tobytes(), "blocks": blocks}
    assert (token_files.decode_segment(row) == ids).all()
    words = bytearray(blocks[0]["words"])
    words[7] ^= 255
    blocks[0]["words"] = bytes(words)
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_segment(row)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, odd_docs, no_docs, plain, tokenizer_path, tmp_path, monkeypatch):
    for segment in (1 << 20, 5):
        monkeypatch.setattr(token_files, "SEGMENT", segment)
        found = [tuple(r) for r in token_files.op4_token_files(odd_docs, str(tmp_path / str(segment)), tokenizer_path).collect()]
        at, want = 0, Counter()
        for doc, start, n, _ in sorted(found, key=lambda r: r[1]):
            assert start == at
            at += n
        ids = sorted((r[0] for r in ODD_ROWS), key=lambda d: (d is not None, d or 0))
        assert [d for d, *_ in sorted(found, key=lambda r: r[1])] == ids
        want = Counter((r[0], len(plain(r[1])) + 1, crc([*plain(r[1]), 2])) for r in ODD_ROWS)
        assert Counter((d, n, c) for d, _, n, c in found) == want
        read = token_files.read(spark, str(tmp_path / str(segment))).collect()
        assert Counter(bytes(r["ids"]) for r in read) == Counter(np.array([*plain(r[1]), 2], "<u4").tobytes() for r in ODD_ROWS)
    assert token_files.op4_token_files(no_docs, str(tmp_path / "none"), tokenizer_path).collect() == []


def check_packing(found, rows, plain, capacity=2048):
    want = Counter()
    for doc, text in rows:
        ids = [*plain(text), 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            want[doc, k, at, len(ids[at : at + capacity]), crc(ids[at : at + capacity])] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    filled = defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_packing_of_odd_rows(odd_docs, no_docs, plain, tokenizer_path):
    found = packing.op10_best_fit_packing(odd_docs, tokenizer_path).collect()
    check_packing(found, [(r[0], r[1]) for r in ODD_ROWS], plain)
    assert packing.op10_best_fit_packing(no_docs, tokenizer_path).collect() == []


def test_packing_is_tight_and_spreads_one_length(make_docs, plain, tokenizer_path):
    rows = [(k, "word " * (3 if k % 3 == 0 else k % 47)) for k in range(600)]
    found = packing.op10_best_fit_packing(make_docs([(*r, "a") for r in rows]), tokenizer_path, capacity=64).collect()
    n = check_packing(found, rows, plain, 64)
    assert n <= math.ceil(sum(r["length"] for r in found) / 64) + 1


def test_sequences_hold_the_ids(make_docs, plain, tokenizer_path):
    rows = [(k, "some words to pack " * (k % 9)) for k in range(40)]
    parts = packing.pieces(make_docs([(*r, "a") for r in rows]), tokenizer_path, 32, with_ids=True)
    for r in packing.sequences(packing.pack(parts, 32)).collect():
        assert sum(len(p["ids"]) // 4 for p in r["parts"]) == r["length"] <= 32


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=20))
def test_plans_use_up_the_histogram(histogram):
    made = packing.plan(histogram, 50)
    used = Counter()
    for lengths, count in made:
        assert sum(lengths) <= 50 and count > 0
        for n in lengths:
            used[n] += count
    assert used == Counter(histogram)
    bound = math.ceil(sum(n * c for n, c in histogram.items()) / 50)
    half = sum(c for n, c in histogram.items() if n > 25)
    assert sum(c for _, c in made) <= max(bound, half) * 1.34 + 2


def plain_targets(sizes, weights=(5, 2, 1)):
    """Share by weight, again and again, until no target is above twice the size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, open_sources, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_sources:
        share = {s: left * weight[s] / sum(weight[o] for o in open_sources) for s in open_sources}
        over = [s for s in open_sources if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_sources.discard(s)
    return target


def test_mixing(make_docs, spark):
    rows = [(k, "w " * (k % 23), f"s{k % 5}" if k % 3 else "s0") for k in range(400)] + [(1000 + k, "w " * 9, None) for k in range(7)] + [(2000, "", "empty")]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(0, 400, 3)] + [(None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    found = mixing.op5_mixing(docs, labels)
    assert "Python" not in found._jdf.queryExecution().toString()
    found = found.collect()
    source, sizes = {r[0]: r[2] for r in rows}, Counter()
    for r in rows:
        sizes[r[2]] += len(r[1].split())
    want, taken = plain_targets(sizes), Counter()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 12
    assert sorted(map(tuple, mixing.op5_mixing(docs.repartition(7), labels).collect()), key=str) == sorted(map(tuple, found), key=str)
    times = Counter(r["doc_id"] for r in mixing.mixed(docs, mixing.quality_weights(labels)).collect())
    assert times == Counter({r["doc_id"]: r["taken"] // r["size"] for r in found if r["taken"]})


def test_better_documents_are_taken_more_often(make_docs, spark):
    rows = [(k, "w " * 10, "a") for k in range(600)] + [(1000 + k, "w " * 10, "b") for k in range(600)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(600)], "doc_id long, quality int, toxic int")
    found = mixing.mix(make_docs(rows), mixing.quality_weights(labels), weights=(1, 9), share=0.6).filter("source = 'a' AND taken > 0").collect()
    good = sum(r["doc_id"] % 2 for r in found)
    assert good > 1.5 * (len(found) - good)


def test_mixing_of_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = mixing.op5_mixing(odd_docs, labels).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in ODD_ROWS)
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    assert set(CLASHING) <= set(mixing.mixed(odd_docs).columns)
    assert mixing.op5_mixing(no_docs, labels).collect() == [] and mixing.mixed(no_docs).collect() == []


def labelled(n):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(n):
        words = [f"plain{w}" for w in rng.integers(0, 300, 40)]
        toxic = int(k % 6 == 0)
        if toxic:
            for at in rng.integers(0, 40, 1 + k % 5):
                words[at] = ("vile", "nasties", "nastiest", "Rotten!")[int(rng.integers(4))]
        rows.append((k, " ".join(words), "a"))
        labels.append((k, 1, toxic))
    return rows, labels


def test_toxicity(make_docs, spark):
    rows, labels = labelled(3000)
    docs, table = make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, table.filter("doc_id % 4 != 0"))
    assert (np.diff(model.thresholds) > 0).all()
    found = toxicity.scored(docs, model).collect()
    truth = {d: t for d, _, t in labels}
    held_out = [r for r in found if r["doc_id"] % 4 == 0]
    assert sum(r["toxic"] == bool(truth[r["doc_id"]]) for r in held_out) / len(held_out) > 0.97
    severe = {n: np.mean([r["severity"] for r in found if truth[r["doc_id"]] and r["doc_id"] % 5 == n]) for n in (0, 4)}
    assert severe[4] > severe[0] + 0.3 and all(0 <= r["severity"] <= 3 and 0 <= r["grade"] <= 3 for r in found)


def test_fit_follows_plain_gradients():
    """The gradient that is used is that of the likelihood: a step against it lowers the loss."""
    rng = np.random.default_rng(1)
    rows = [{int(f): int(n) for f, n in zip(rng.choice(6, 3, replace=False), rng.integers(1, 4, 3))} for _ in range(200)]
    true = np.array([2.0, -1.0, 0.5, 0, 1.0, -2.0])
    score = np.array([sum(true[f] * np.log1p(n) for f, n in r.items()) for r in rows])
    grades = (score[:, None] + rng.logistic(size=(200, 1)) > np.array([-1.0, 0.5, 2.0])).sum(1)
    weights, thresholds = toxicity.fit(rows, grades, 6, steps=800, prior=0)

    def loss(w, t):
        s = np.array([sum(w[f] * np.log1p(n) for f, n in r.items()) for r in rows])
        below = 1 / (1 + np.exp(-(np.concatenate([[-np.inf], t, [np.inf]])[:, None] - s)))
        return -np.log(below[grades + 1, np.arange(200)] - below[grades, np.arange(200)]).mean()

    best = loss(weights, thresholds)
    for k in range(6):
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[k] += step
            assert loss(moved, thresholds) > best - 1e-5


def test_toxicity_of_odd_rows(odd_docs, no_docs, spark, make_docs):
    rows, labels = labelled(300)
    table = spark.createDataFrame([*labels, (None, 1, 1), (1, 1, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(make_docs(rows), table)
    found = toxicity.scored(odd_docs, model)
    assert {c for c in CLASHING if c != "severity"} <= set(found.columns)
    rows = found.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD_ROWS) and not any(r["toxic"] for r in rows)
    assert toxicity.scored(no_docs, model).collect() == []
    for some in (table.filter("toxic = 5"), table.filter("toxic = 1")):
        found = toxicity.op8_toxicity(odd_docs, some).collect()
        assert len(found) == len(ODD_ROWS) and not any(r["toxic"] or r["severity"] for r in found)
    assert toxicity.op8_toxicity(no_docs, table).collect() == []
