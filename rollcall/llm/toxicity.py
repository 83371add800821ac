"""Severity of toxic documents (operator 8).

Method: cumulative-link ordinal regression. Grades 0 (clean) to 3 are ordered; the chance that a document's
grade is k or more is sigmoid(w.x - t_k) with one set of weights w for all thresholds t_1 < t_2 < t_3. The
expected severity is the sum of these chances. Features are sparse: words of the text and beginnings of
words, each with log(1 + count).

Labels say toxic or not. The grades of toxic documents come from how many words they hold that only
toxic documents use: up to a third of the toxic documents each have grade 1, 2 and 3, by that number.

Fit: on at most ``SAMPLE`` labelled documents, those of the smallest digests of their ids, so that the
table of their ids can be broadcast. Of rows that share an id one is taken, so the sample bounds what comes to the driver. Spark counts in how many toxic and clean ones each feature stands,
those that tell the two apart are kept, ``FEATURES`` at most (both numbers are parameters), and the few features of each
document are fitted on the driver. All documents and whole texts are scored.

Defined cases: null and blank texts have no features. Documents labelled more than once are toxic if any
label says so; labels without id or grade, and labels of unknown documents, are left out. Without toxic
or without clean documents in the sample nothing is toxic. Repeated rows are scored alike. An empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.keys import unpacked, whole
from rollcall.storage import land

#: Labelled documents to fit on; features kept; documents a feature has to stand in; grades above 0.
SAMPLE, FEATURES, LEAST, GRADES = 20_000, 4_000, 5, 3
#: Chi-squared from which a feature tells toxic documents from clean ones; chance alone gives one in 10^7 features more than 28.
TELLING = 30.0
#: Lengths of beginnings of words; bytes of text handled together.
BEGINNINGS, SLICE = (4, 5, 6), 4_000_000


def _words(texts: pa.StringArray) -> pa.ListArray:
    """Runs of letters and digits, lowered."""
    return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " "))


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) > n)] if word else []


def _slices(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    texts = texts.fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE)))
        yield texts.slice(at, upto - at)
        at = upto


def counted(texts: pa.StringArray, known: dict[str, int]) -> Iterator[dict[int, int]]:
    """For each text the numbers of the known features that stand in it, and how often."""
    for some in _slices(texts):
        words = _words(some)
        distinct = words.flatten().dictionary_encode()
        hits = [[known[f] for f in features(w) if f in known] for w in distinct.dictionary.to_numpy(zero_copy_only=False).tolist()]
        telling = np.fromiter((bool(h) for h in hits), bool, len(hits))
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        edges = words.offsets.to_numpy() - words.offsets[0].as_py()
        places = np.flatnonzero(telling[codes]) if len(codes) else np.empty(0, np.int64)
        cuts = np.searchsorted(places, edges)
        for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            out: dict[int, int] = {}
            for code in codes[places[a:b]].tolist():
                for f in hits[code]:
                    out[f] = out.get(f, 0) + 1
            yield out


@dataclass
class Model:
    """Numbers of features, their weights, and the rising thresholds of the grades."""

    known: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, found: dict[int, int]) -> np.ndarray:
        """Chance of grade k or more, for k from 1."""
        score = sum(self.weights[f] * np.log1p(n) for f, n in found.items())
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds - score))


def fit(rows: list[dict[int, int]], grades: np.ndarray, n_features: int, steps: int = 400, prior: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps on the ordinal likelihood, weights with a normal prior of variance 1 / ``prior``."""
    n, top = len(rows), int(GRADES)
    penalty = prior / n
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    column = np.array([f for r in rows for f in r], np.int64)
    value = np.log1p(np.array([c for r in rows for c in r.values()], float))
    weights = np.zeros(n_features)
    shares = [np.clip((grades >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, top + 1)]
    start = np.log((1 - np.array(shares)) / np.array(shares))
    # Thresholds stay in order: the first, and the logarithms of the steps between them.
    steps_up = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([weights, start[:1], steps_up])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for turn in range(1, steps + 1):
        weights, low, ups = params[:n_features], params[n_features], np.exp(params[n_features + 1 :])
        thresholds = low + np.concatenate([[0], np.cumsum(ups)])
        score = np.bincount(owner, weights[column] * value, n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        below, above = (1 / (1 + np.exp(-np.clip(edges[grades + k] - score, -500, 500))) for k in (1, 0))
        chance = np.maximum(below - above, 1e-12)
        d_below, d_above = below * (1 - below) / chance, above * (1 - above) / chance
        d_score = d_below - d_above  # of minus the log-likelihood
        d_edges = np.zeros(top + 2)
        np.add.at(d_edges, grades + 1, -d_below)
        np.add.at(d_edges, grades, d_above)
        d_thresholds = d_edges[1:-1]
        later = np.cumsum(d_thresholds[::-1])[::-1]
        gradient = np.concatenate([np.bincount(column, d_score[owner] * value, n_features) / n + penalty * weights, [later[0] / n], later[1:] * ups / n])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        params = params - 0.1 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1 :]))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = FEATURES) -> Model:
    """Fit on a bounded sample of the documents that have a label."""
    graded = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = F.broadcast(graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # at most `sample` rows of two numbers
    # One text per id, whatever rows share it: the one with the smallest mark.
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(chosen, "doc_id").groupBy("doc_id").agg(
        F.first("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("own")
    )
    rows = land(rows.select("toxic", F.col("own.text").alias("text")), "sample", 80 * sample)

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, at = batch.column(0).to_pylist(), 0
            for some in _slices(batch.column(1)):  # counts of a slice at a time bound the memory
                # The empty feature counts the documents themselves.
                counts = (Counter(), Counter())
                for words in _words(some):
                    counts[toxic[at]].update({"", *(f for w in set(words.as_py()) for f in features(w))})
                    at += 1
                keys = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], names=["feature", "clean", "toxic"]
                )

    counts = rows.mapInArrow(stand, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.filter(f"feature = '' OR clean + toxic >= {LEAST}")
    counts = land(counts, "features", 80 * sample)
    all_rows = counts.filter("feature = ''").first()
    if all_rows is None or not all_rows["clean"] or not all_rows["toxic"]:
        return Model({}, np.empty(0), np.full(GRADES, np.inf))
    n_clean, n_toxic = all_rows["clean"], all_rows["toxic"]
    # Chi-squared of the feature against the label.
    a, b = F.col("toxic") / n_toxic, F.col("clean") / n_clean
    both = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    telling = (a - b) * (a - b) / (both * (1 - both) + F.lit(1e-9)) * (n_toxic * n_clean / (n_toxic + n_clean))
    top = counts.filter("feature != ''").withColumn("telling", telling).filter(F.col("telling") > TELLING).orderBy(F.desc("telling"), "feature").limit(n_features).collect()
    known = {r["feature"]: k for k, r in enumerate(top)}
    own = {k for k, r in enumerate(top) if r["feature"].startswith("=") and r["toxic"] / n_toxic > 20 * r["clean"] / n_clean}

    found = collect_counts(rows, known)
    toxic = np.array([t for t, _ in found])
    strength = np.array([sum(n for f, n in c.items() if f in own) for _, c in found])
    cuts = np.quantile(strength[toxic == 1], [k / GRADES for k in range(1, GRADES)])
    grades = np.where(toxic == 1, 1 + (strength[:, None] > cuts).sum(1), 0)
    weights, thresholds = fit([c for _, c in found], grades, len(known))
    return Model(known, weights, thresholds)


def collect_counts(rows: DataFrame, known: dict[str, int]) -> list[tuple[int, dict[int, int]]]:
    """The known features of the sampled documents; as many rows as the sample has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(counted(batch.column(1), known))
            arrays = [batch.column(0), pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "f", "n"])

    table = rows.mapInArrow(run, "toxic int, f array<int>, n array<int>").toArrow().to_pylist()
    # In an order of their own, so that the fit does not hang on the order of tasks.
    return sorted(((r["toxic"], dict(zip(r["f"], r["n"], strict=True))) for r in table), key=lambda r: (r[0], sorted(r[1].items())))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with severity (expected grade), grade (the likeliest) and toxic (grade 1 or more is likelier than not)."""
    added = ("severity", "grade", "toxic")
    rows = docs.select(whole(docs, *added).alias("document"), "text")
    schema = T.StructType([rows.schema["document"], *(T.StructField(c, t()) for c, t in zip(added, (T.DoubleType, T.IntegerType, T.BooleanType), strict=True))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many weights as features were kept

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        empty = model.chances({})
        for batch in batches:
            chances = np.array([model.chances(f) if f else empty for f in counted(batch.column(1), model.known)]).reshape(-1, GRADES)
            each = -np.diff(np.concatenate([np.ones((len(chances), 1)), chances, np.zeros((len(chances), 1))], axis=1), axis=1)
            found = [batch.column(0), pa.array(chances.sum(1)), pa.array(each.argmax(1), pa.int32()), pa.array(chances[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays(found, names=schema.names)

    return rows.mapInArrow(score, schema).select(*unpacked(docs, "document", *added), *added)


def op8_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, grade and toxic of every document."""
    return scored(docs.select("doc_id", "text"), train(docs, labels)).select("doc_id", "severity", "grade", "toxic")
