"""Near-duplicate vectors, top-k search and components against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from rollcall.llm import graph, near_vectors, top_scores

from .conftest import ODD_VECTORS


def usable(v, label=True):
    return v[1] is not None and all(x is not None and math.isfinite(x) for x in v[1]) and (not label or (v[2] is not None and any(v[1])))


def roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(k) for k in range(n)]


def plain_near(vectors):
    links = []
    for a, v in enumerate(vectors):
        for b, w in enumerate(vectors[:a]):
            if usable(v) and usable(w) and v[2] == w[2] and len(v[1]) == len(w[1]):
                x, y = np.array(v[1], np.float32).astype(float), np.array(w[1], np.float32).astype(float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((a, b))
    root, count = roots(len(vectors), links), Counter(x for pair in links for x in pair)
    low = {}
    for k, v in enumerate(vectors):
        if v[0] is not None:
            low[root[k]] = min(v[0], low.get(root[k], v[0]))
    return Counter((v[0], count[k], low.get(root[k]), v[0] == low.get(root[k])) for k, v in enumerate(vectors))


def clustered(n, seed=2):
    """Vectors in tight and loose groups, one of them large."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        group = 0 if k % 3 == 0 else int(rng.integers(1, 60))
        centre = np.random.default_rng(group).normal(size=16)
        x = centre + rng.normal(size=16) * (0.03 if group == 0 else float(rng.choice([0.02, 0.1, 0.3])))
        out.append((k, x.astype(np.float32).tolist(), group % 3))
    return out


def rows_of(spark, vectors):
    return spark.createDataFrame([(*v, "x", "y") for v in vectors], "vec_id long, embedding array<float>, label int, node string, row string")


@pytest.mark.parametrize(("shard", "queries"), [(4096, 4096), (40, 30)])
def test_near_vectors(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(near_vectors, "SHARD", shard)
    monkeypatch.setattr(near_vectors, "QUERIES", queries)
    vectors = clustered(500)
    assert Counter(map(tuple, near_vectors.op3_embedding_near_dedup(rows_of(spark, vectors)).collect())) == plain_near(vectors)


def test_odd_vectors(odd_vectors, no_vectors):
    assert Counter(map(tuple, near_vectors.op3_embedding_near_dedup(odd_vectors).collect())) == plain_near(ODD_VECTORS)
    assert near_vectors.op3_embedding_near_dedup(no_vectors).collect() == []


def test_graphs_find_nearly_all_with_a_narrow_beam():
    vectors = np.array([v[1] for v in clustered(1500, 9)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = near_vectors.Graph(unit).search(unit[:200], 0.98, near_vectors.BEAM)
    truth = [np.flatnonzero(r >= 0.98) for r in unit[:200] @ unit.T]
    assert sum(len(np.intersect1d(a, b)) for a, b in zip(found, truth)) >= 0.9 * sum(map(len, truth))
    assert all((unit[f] @ q >= 0.98).all() for f, q in zip(found, unit))


def counted_in_a_shard(vectors, queries, first):
    """Links of queries, numbered from ``first`` on, that one cell finds and that there are."""
    table = lambda rows, at: pd.DataFrame({"node": np.arange(at, at + len(rows)), "copies": 1, "values": [r.tobytes() for r in rows]})
    out = near_vectors._query(0.98)(table(queries, first)[["node", "values"]], near_vectors._build((0, vectors.shape[1], 0), table(vectors, 0)))
    counts = out.groupby("node")["n_links"].sum()
    unit, asked = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (vectors, queries))
    close = asked @ unit.T >= 0.98
    want = close.sum(1) - (close[np.arange(len(queries)), np.arange(len(queries))] if first == 0 else 0)
    return np.array([counts.get(first + k, 0) for k in range(len(queries))]), want


def test_a_large_group_hides_no_losses_of_others():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 64))
    vectors[:666] = vectors[0] + rng.normal(size=(666, 64)) * 0.01
    vectors[1333:] = vectors[666:1333] + rng.normal(size=(667, 64)) * 0.1
    vectors = vectors[rng.permutation(2000)]
    got, want = counted_in_a_shard(vectors, vectors, 0)
    few = (want > 0) & (want < 50)
    assert few.sum() > 1300 and (got[few] / want[few]).mean() >= 0.99 and got.sum() >= 0.999 * want.sum()


def test_cells_almost_without_links_are_audited():
    rng = np.random.default_rng(4)
    vectors, queries = rng.normal(size=(2000, 256)), rng.normal(size=(2000, 256))
    linked = np.setdiff1d(np.arange(0, 2000, 4), np.linspace(0, 1999, near_vectors.AUDITED).astype(int))
    queries[linked] = vectors[linked] + rng.normal(size=(len(linked), 256)) * 0.18
    got, want = counted_in_a_shard(vectors, queries, 5000)
    assert want.sum() > 300 and (got == want).all()


def plain_top(vectors, k):
    good = [v for v in vectors if v[0] is not None and usable(v, label=False)]
    size = max((len(v[1]) for v in good), default=0)
    numbers = [[math.floor(256 * float(np.float32(x))) for x in v[1]] + [0] * (size - len(v[1])) for v in good]
    out = []
    for a, v in enumerate(good):
        if v[0] % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(numbers[a], numbers[b])), w[0]) for b, w in enumerate(good) if b != a)
            out += [(v[0], rank, other, -score) for rank, (score, other) in enumerate(scores[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize(("k", "lists", "block"), [(5, 2, 2048), (3, 4, 60), (1, 1, 1000)])
def test_top_scores(spark, monkeypatch, k, lists, block):
    from pyspark.sql import functions as F

    monkeypatch.setattr(top_scores, "BLOCK", block)
    monkeypatch.setattr(top_scores, "QUERY_BLOCK", 7)
    vectors = clustered(800, 4) + [(900, [-1.0] * 16, 0), (950, [0.0] * 16, 1), (950, [0.0] * 16, 1)]
    found = top_scores.top_k(rows_of(spark, vectors), F.col("vec_id") % 50 == 0, k, lists).collect()
    assert Counter(map(tuple, found)) == plain_top(vectors, k)


def test_a_cell_sends_on_k_pairs_of_a_query_however_many_tie():
    import pandas as pd

    rng = np.random.default_rng(2)
    values = [np.full(8, 3.0)] * 500 + list(np.floor(rng.normal(size=(500, 8)) * 4))
    order = rng.permutation(1000)
    candidates = pd.DataFrame({"row": np.arange(1000), "vec_id": order, "values": [values[v].tobytes() for v in order]})
    queries = candidates[candidates["vec_id"] % 100 == 0].assign(cutoff=10.0)
    found = top_scores._reaching(2, 5)(queries, candidates).groupby("q_row")["c_row"].nunique()
    assert found.max() == 5
    ids = dict(zip(candidates["row"], candidates["vec_id"], strict=True))
    pairs = top_scores._reaching(2, 5)(queries, candidates)[["q_row", "c_row"]].drop_duplicates()
    for q in queries.itertuples():
        x = np.frombuffer(q.values, float)
        ranked = sorted((-float(x @ np.frombuffer(c.values, float)), c.vec_id) for c in candidates.itertuples() if c.row != q.row and x @ np.frombuffer(c.values, float) >= 10)
        assert sorted(v for _, v in ranked[:5]) == sorted(ids[c] for c in pairs[pairs["q_row"] == q.row]["c_row"])


def test_scores_that_could_not_be_exact_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        top_scores.op6_exact_top_k(rows_of(spark, [(50, [1e12, 1.0], 0), (51, [1e12, 2.0], 0)]))


def test_top_scores_of_odd_vectors(spark, odd_vectors, no_vectors):
    assert Counter(map(tuple, top_scores.op6_exact_top_k(odd_vectors).collect())) == plain_top(ODD_VECTORS, 5)
    assert top_scores.op6_exact_top_k(no_vectors).collect() == []
    few = [v for v in ODD_VECTORS if v[0] in (50, 100, 1)]
    assert Counter(map(tuple, top_scores.op6_exact_top_k(rows_of(spark, few)).collect())) == plain_top(few, 5)


def test_components(spark):
    rng = random.Random(3)
    for n, m in ((1, 0), (60, 45), (200, 120)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(0, min(n - 1, 30))] + [(n, n + 1)]
        links = [(a, b) for a, b in links if a != b]
        root = roots(n + 2, links)
        low = {}
        for k, r in enumerate(root):
            low.setdefault(r, k)
        touched = {x for pair in links for x in pair}
        found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert Counter(map(tuple, found)) == Counter((k, low[root[k]]) for k in touched)
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []
