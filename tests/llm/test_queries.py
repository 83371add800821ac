"""The registered queries over whole small tables, against SQL or the plain versions."""

import math
from collections import Counter
from pathlib import Path

import pytest
from rollcall.llm import oracle, toxicity
from rollcall.llm.queries import QUERIES
from tokenizers import Tokenizer

import __spark_entry__ as entry
from checks.compare import connect, difference

from .test_corpus_operators import check_packing, crc
from .test_text_operators import digest, plain_components, plain_substrings, plain_table
from .test_vector_operators import plain_near, plain_top

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def vectors(spark):
    return [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]


def found(spark, name):
    return Counter(map(tuple, QUERIES[name](spark, SF_DIR).collect()))


def test_one_query_per_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(oracle.SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), oracle.SQL[name]) is None


@pytest.mark.parametrize("name", ["op1_sharding", "op5_mixing", "op9_line_dedup", "op11_secret_scans"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_shards(spark, docs):
    table = plain_table([f"shard-{k:03d}" for k in range(64)], 6421)
    assert found(spark, "op1_sharding") == Counter((d, digest(str(d)) % 6421, table[digest(str(d)) % 6421]) for d, _ in docs)


def test_near_duplicate_texts(spark, docs):
    assert found(spark, "op2_minhash_near_dedup") == plain_components(docs)


def test_near_duplicate_vectors(spark, vectors):
    assert found(spark, "op3_embedding_near_dedup") == plain_near(vectors)


def test_token_files(spark, docs, tokenizer_path):
    tokenizer, at, want = Tokenizer.from_file(tokenizer_path), 0, Counter()
    for doc, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc, at, len(ids), crc(ids)] += 1
        at += len(ids)
    assert found(spark, "op4_token_files") == want


def test_top_scores(spark, vectors):
    assert found(spark, "op6_exact_top_k") == plain_top(vectors, 5)


def test_substrings(spark, docs):
    assert found(spark, "op7_substring_dedup") == plain_substrings(docs, 35)


def test_toxicity(spark, docs):
    """Every score again from the weights, word by word."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels)
    rows = QUERIES["op8_toxicity"](spark, SF_DIR).collect()
    texts = dict(docs)
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in docs) and len(model.known) > 5
    for r in rows:
        counts = Counter()
        for word in "".join(c if c.isalnum() else " " for c in (texts[r["doc_id"]] or "").lower()).split():
            counts.update(f for f in ["=" + word, *(word[:n] for n in (4, 5, 6) if len(word) > n)] if f in model.known)
        score = sum(model.weights[model.known[f]] * math.log1p(n) for f, n in counts.items())
        chances = [1 / (1 + math.exp(min(t - score, 700))) for t in model.thresholds]
        each = [1 - chances[0], *(a - b for a, b in zip(chances, [*chances[1:], 0]))]
        assert r["severity"] == pytest.approx(sum(chances), abs=1e-9) and r["toxic"] == (chances[0] >= 0.5) and r["grade"] == each.index(max(each))


def test_packing(spark, docs, tokenizer_path):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    rows = QUERIES["op10_best_fit_packing"](spark, SF_DIR).collect()
    n = check_packing(rows, docs, lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 2
