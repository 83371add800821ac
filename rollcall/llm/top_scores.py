"""Exact top-k search by inner product (operator 6).

Method: three-phase uniform threshold. A score is the sum of local scores of ``LISTS`` lists, each over its
own share of the components.

1. Of each list the ``k`` highest local scores of a query are gathered, and the candidates named there get
   their whole scores. The k-th highest of them is a safe cutoff: the answer is not below it.
2. The cutoff goes back with the query. A candidate that reaches it has a local score of at least cutoff /
   LISTS in one list at least, so all entries from there on are looked at, and with them the answer.
3. Candidates whose sum is still open, that is entries of other lists were below the share, are resolved
   exactly by their vectors; those that fall below the cutoff go. Then the best k stay.

Queries and candidates meet in cells of a block of queries and a block of candidates, of bounded size, in
plain numbers: whole numbers below 2^53 add up exactly in double precision. A cell has all lists of its pairs, so of
the entries that phase 2 looks at it sends on those pairs that reach the cutoff as a whole, and of these the k best
of each query, by score and id. However many candidates tie, a cell sends k at most.

Defined cases: vectors that are null or hold null, NaN or infinite components, and rows without an id, take
no part. Vectors that are shorter than the longest are filled with zeros. Equal scores are ranked by
smaller id. Rows that repeat an id are candidates of their own; only the query's own row is left out. With
fewer than k candidates a query returns all of them. Components so large that a score might not be below 2^53 are
refused with an error. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.storage import land

#: Results of a query; lists that a score is split into; rows in a block of queries and of candidates.
K, LISTS, QUERY_BLOCK, BLOCK = 5, 2, 8192, 2048
#: Queries handled together within a cell.
_TOGETHER = 512


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row (a number of its own), vec_id, values (floor(scale * x), zeros behind, as packed doubles) of vectors that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
    largest = F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))
    size, most = good.agg(F.max(F.size("embedding")), largest).first()
    size = size or 0
    if size * (scale * (most or 0.0) + 1) ** 2 >= 1 << 53:
        raise ValueError("components are too large for exact scores")

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            packed = []
            for v in batch.column(2):
                out = np.zeros(size)
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                out[: len(x)] = np.floor(scale * x)
                packed.append(out.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["row", "vec_id", "values"])

    numbered = good.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    return numbered.mapInArrow(pack, "row long, vec_id long, values binary")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _parts(width: int, lists: int) -> list[slice]:
    edges = np.linspace(0, width, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _local(queries: pd.DataFrame, candidates: pd.DataFrame, lists: int):
    """(numbers of some queries, list, local scores with minus infinity for the query itself)."""
    q, c = _matrix(queries["values"]), _matrix(candidates["values"])
    own = candidates["row"].to_numpy()
    for at in range(0, len(q), _TOGETHER):
        some = np.arange(at, min(at + _TOGETHER, len(q)))
        itself = queries["row"].to_numpy()[some][:, None] == own[None, :]
        for number, part in enumerate(_parts(q.shape[1], lists)):
            scores = q[some, part] @ c[:, part].T
            scores[itself] = -np.inf
            yield some, number, scores


_ENTRY = "q_row long, c_row long, list int, local double"


def _entries(queries: pd.DataFrame, candidates: pd.DataFrame, found: list) -> pd.DataFrame:
    q, c = queries["row"].to_numpy(), candidates["row"].to_numpy()
    rows = [pd.DataFrame({"q_row": q[i], "c_row": c[j], "list": np.int32(n), "local": s}) for i, j, n, s in found if len(i)]
    return pd.concat(rows) if rows else pd.DataFrame({"q_row": [], "c_row": [], "list": [], "local": []}).astype({"q_row": "int64", "c_row": "int64", "list": "int32", "local": "float64"})


def _highest(k: int, lists: int):
    """Phase 1 in a cell: the k best local scores of each query and list."""

    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            for some, number, scores in _local(queries, candidates, lists):
                n = min(k, scores.shape[1])
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                i, j = np.repeat(np.arange(len(some)), n), best.ravel()
                real = scores[i, j] > -np.inf
                found.append((some[i[real]], j[real], number, scores[i, j][real]))
        return _entries(queries, candidates, found)

    return run


def _reaching(lists: int, k: int):
    """Phase 2 in a cell: pairs with a local score from a query's share of its cutoff on and a whole score from the cutoff on, the k best of each query."""

    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            cutoff, ids, rows = queries["cutoff"].fillna(-np.inf).to_numpy(float), candidates["vec_id"].to_numpy(), candidates["row"].to_numpy()
            parts = _local(queries, candidates, lists)
            for group in zip(*[parts] * lists, strict=True):  # all lists of the same queries
                some, scores = group[0][0], [local for _, _, local in group]
                share, whole = cutoff[some][:, None] / lists, sum(scores)
                listed = np.logical_or.reduce([local >= share for local in scores])
                i, j = np.nonzero(listed & (whole >= cutoff[some][:, None]) & (whole > -np.inf))
                order = np.lexsort((rows[j], ids[j], -whole[i, j], i))
                i, j = i[order], j[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[place < k], j[place < k]
                found += [(some[i][local[i, j] >= share[i, 0]], j[local[i, j] >= share[i, 0]], n, local[i, j][local[i, j] >= share[i, 0]]) for n, local in enumerate(scores)]
        return _entries(queries, candidates, found)

    return run


def _whole(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``pairs`` (q_row, c_row, ...) with query_id, vec_id and the exact score from the vectors."""
    q = queries.select(F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), F.col("values").alias("x"))
    c = rows.select(F.col("row").alias("c_row"), "vec_id", F.col("values").alias("y"))

    def product(batches):
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.float64).reshape(batch.num_rows, -1) for n in ("x", "y"))
            kept = [n for n in batch.schema.names if n not in ("x", "y")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array((x * y).sum(1).astype(np.int64))], names=[*kept, "score"])

    joined = pairs.join(q, "q_row").join(c, "c_row")
    kept = [f for f in joined.schema.fields if f.name not in ("x", "y")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", score long"
    return joined.select(*(f.name for f in kept), "x", "y").mapInArrow(product, schema)


def top_k(vectors: DataFrame, is_query, k: int = K, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row for which ``is_query`` holds."""
    rows = prepared(vectors)
    rows = land(rows, "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    q_blocks, blocks = max(1, -(-counts["q"] // QUERY_BLOCK)), max(1, -(-counts["n"] // BLOCK))
    queries = rows.filter(is_query)

    def cells(queries: DataFrame, run) -> DataFrame:
        left = queries.withColumn("q_block", F.pmod(F.xxhash64("row"), F.lit(q_blocks))).withColumn("c_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        right = rows.select(*(F.col(c).alias(c) for c in rows.columns)).withColumn("c_block", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
        return left.groupBy("q_block", "c_block").cogroup(right.groupBy("q_block", "c_block")).applyInPandas(run, _ENTRY)

    # Phase 1. A block's share of a list holds k entries per query, and Spark keeps the first k before it shuffles them.
    in_list = F.row_number().over(Window.partitionBy("q_row", "list").orderBy(F.desc("local"), "c_row"))
    named = cells(queries, _highest(k, lists)).withColumn("place", in_list).filter(F.col("place") <= k).select("q_row", "c_row").distinct()
    best = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "c_row"))
    seen = _whole(named, queries, rows).withColumn("rank", best)
    cutoffs = land(seen.filter(F.col("rank") == k).select(F.col("q_row").alias("row"), F.col("score").cast("double").alias("cutoff")), "cutoffs")

    # Phase 2. Queries without a cutoff have fewer than k candidates, or lists so alike that they name fewer than k; they collect all.
    collected = cells(queries.join(cutoffs, "row", "left"), _reaching(lists, k))
    sums = collected.groupBy("q_row", "c_row").agg(F.sum("local").alias("known"), F.count("*").alias("lists")).join(
        cutoffs.select(F.col("row").alias("q_row"), "cutoff"), "q_row", "left"
    )
    # Phase 3. A list that did not report is below its share of the cutoff.
    open_sums = sums.filter(F.col("cutoff").isNull() | (F.col("known") + (lists - F.col("lists")) * F.col("cutoff") / lists >= F.col("cutoff")))
    exact = _whole(open_sums.select("q_row", "c_row"), queries, rows)
    return exact.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_exact_top_k(vectors: DataFrame) -> DataFrame:
    """The 5 best of all other rows for every row whose id is divisible by 50."""
    return top_k(vectors, F.col("vec_id") % 50 == 0)
