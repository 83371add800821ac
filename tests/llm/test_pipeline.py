"""The stages of the pipeline against plain versions, each judged on its own input."""

from collections import Counter
from itertools import combinations

import corpus_pipeline
import pytest
from rollcall.llm import toxicity
from tokenizers import Tokenizer

from .conftest import ODD_ROWS
from .test_corpus_operators import check_packing, labelled, plain_targets
from .test_text_operators import mark_of, plain_lines, shingle_set

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def corpus():
    rows, labels = labelled(400)
    lines = "\n".join(f"shared line {k}" for k in range(4))
    rows += [(1000 + k, f"own {k} start\n{lines}\nown {k} end", "b") for k in range(6)] + [(1100 + k, lines, None) for k in range(3)]
    base = [f"base{k}" for k in range(100)]
    rows += [(1200 + k, " ".join([*base[:50], f"new{k}", *base[51:]]), "b") for k in range(5)]
    return rows + [(None if r[0] is None else 5000 + r[0], *r[1:]) for r in ODD_ROWS], labels


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    rows, labels = corpus
    as_documents(spark, rows).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def rows_of(df):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())


def test_the_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-duplicate texts", "mixing to target weights", "best-fit packing"]


def test_toxic_documents_go(spark, corpus, folder):
    docs = as_documents(spark, corpus[0])
    out = corpus_pipeline.without_toxic(spark, docs, folder)
    assert out.columns == COLUMNS
    toxic = {d for d, _, t in corpus[1] if t}
    kept = rows_of(out)
    clean = Counter(r for r in corpus[0] if r[0] not in toxic)
    assert not clean - kept and sum((kept - clean).values()) <= 0.05 * len(toxic)
    scores = toxicity.scored(docs, toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))).filter("NOT toxic")
    assert rows_of(scores) == kept


def test_repeated_lines_go(spark, corpus, folder):
    out = corpus_pipeline.without_repeated_lines(spark, as_documents(spark, corpus[0]), folder)
    assert out.columns == COLUMNS
    want = plain_lines([(d, t) for d, t, _ in corpus[0]], 1)
    want = Counter({(d, t): n for (d, lines, gone, t), n in want.items() if gone < lines or not lines})
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


def plain_stay(rows, percent):
    """Of each component of distinct (doc_id, text) rows the first by id, null ids last; rows without words all."""
    distinct = sorted({r[:2] for r in rows if shingle_set(r[1])}, key=lambda r: (r[0] is None, r[0] or 0, mark_of(r[1])))
    sets, group = [shingle_set(t) for _, t in distinct], list(range(len(distinct)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(range(len(distinct)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            group[y] = x
    out = Counter(distinct[k] for k in range(len(distinct)) if group[k] == k)
    return out + Counter(r[:2] for r in rows if not shingle_set(r[1]))


def test_one_of_each_group_stays(spark, corpus, folder):
    odd = [(1, "text of its own", "a"), (1, "something else entirely", "a"), (None, "x y", "a"), (None, "z", "a"), (None, "", "a"), (None, "", "a")]
    odd += [(None, " ".join(f"null{j}" for j in range(200) if j != 3 * k), "a") for k in range(3)]
    rows = corpus[0] + [corpus[0][0]] * 2 + odd
    out = corpus_pipeline.without_near_duplicates(spark, as_documents(spark, rows), folder)
    assert out.columns == COLUMNS
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == plain_stay(rows, 80)


def test_pairs_between_the_thresholds_of_stage_and_query_go(spark, folder):
    """Pairs planted at 0.80 to 0.85 and just below 0.80, against brute force over all pairs."""
    rows = []
    for k in range(60):
        words = [f"p{k}w{n}" for n in range(104 + 9 * (k % 3))]
        rows.append((2 * k, " ".join(words), "a"))
        size = len(words) - 4
        # A tail of its own for one of the two: similarity shared / size, a shade below 0.80 for every fourth pair.
        shared = -(-size * (80 + k % 5) // 100) if k % 4 else size * 80 // 100 - 1
        rows.append((2 * k + 1, " ".join(words[: shared + 4]), "a"))
    sets = [shingle_set(t) for _, t, _ in rows]
    alike = [len(x & y) / len(x | y) for x, y in zip(sets[::2], sets[1::2])]
    assert sum(0.8 <= s < 0.85 for s in alike) == 45 and sum(0.77 < s < 0.8 for s in alike) == 15
    gone = {max(rows[a][0], rows[b][0]) for a, b in combinations(range(len(rows)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    out = corpus_pipeline.without_near_duplicates(spark, as_documents(spark, rows), folder)
    assert {r["doc_id"] for r in out.collect()} == {d for d, _, _ in rows} - gone and len(gone) == 45


def test_sources_come_near_their_targets(spark, corpus, folder):
    out = corpus_pipeline.to_target_weights(spark, as_documents(spark, corpus[0]), folder)
    assert out.columns == COLUMNS
    sizes, taken = Counter(), Counter()
    for _, text, source in corpus[0]:
        sizes[source] += len((text or "").split())
    given = Counter(corpus[0])
    for row, n in rows_of(out).items():
        taken[row[2]] += n * len((row[1] or "").split())
        assert n <= 2 * given[row]
    # Documents are taken whole, so a source may miss its target by half of its longest document.
    want, longest = plain_targets(sizes), Counter()
    for _, text, source in corpus[0]:
        longest[source] = max(longest[source], len((text or "").split()))
    for source in sizes:
        assert abs(taken[source] - want[source]) <= longest[source] / 2 + 1


def test_the_last_stage_packs_all(spark, corpus, folder, tokenizer_path):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    rows = [(d, t) for d, t, _ in corpus[0]] * 2  # a mix repeats documents
    out = corpus_pipeline.into_sequences(spark, as_documents(spark, corpus[0] * 2), folder).collect()
    check_packing(out, rows, lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_the_whole_run(spark, folder, tmp_path):
    first = Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, folder).collect())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert Counter(tuple(r)[:5] for r in docs.collect()) == first and first
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"none/{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
