"""Near-duplicate vectors by cosine (operator 3).

Method: a hierarchical navigable small-world graph per shard. Vectors with equal labels are dealt to shards
of about ``SHARD`` vectors; each shard's graph is built once and written. Every vector of a label then
queries every shard of the label, in blocks: a beam search down the levels, then from what it has found
on through the lowest level as long as neighbours are similar, so that a group of very many near copies is
followed to its end. A sample of a block's queries is compared with all vectors of the shard, and the beam is
doubled until each of them, by itself, has found ``AUDIT`` of its links; its own place is no link. Where fewer
than ``LINKED`` of them have links, as in most shards of a large label, each of the others has to find
its nearest vector too. Beams wider than ``WIDEST`` become as wide as the shard, which looks at every vector. Links are verified by cosine in double precision. A block gives a count of links per vector
and the links that join its components, not all pairs; the components of all blocks are united.

Vectors equal in label and all components are one class, which stands for each of them.

Defined cases: rows with a null label link with nothing, nor do vectors that are null, empty, zero or hold null,
NaN or infinite components; they are their own component. Vectors of different lengths do not link.
Rows that repeat an id link like others. Null ids are left out of the smallest id of a component; a
component without any id has null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.graph import components
from rollcall.storage import land

THRESHOLD = 0.98
#: Vectors in a shard and in a block of queries, about.
SHARD, QUERIES = 4096, 4096
#: Neighbours kept per vector above the lowest level and on it; beam of the build and of the first search.
NEIGHBOURS, LOWEST, BUILD_BEAM, BEAM = 12, 24, 40, 16
#: Share of its links that each audited query has to find, queries audited per block, and how many with links suffice for that.
AUDIT, AUDITED, LINKED = 0.999, 64, 32
#: The widest beam before all vectors are looked at, which takes less time than a wider one.
WIDEST = 128
#: How far below the threshold a vector may be and still lead on to others.
SLACK = 0.03
_TOGETHER = 256


class Graph:
    """One shard: unit vectors, and for each level the neighbours of the vectors on it."""

    def __init__(self, unit: np.ndarray) -> None:
        self.unit, self._both = unit, None
        n = len(unit)
        # Levels from a fixed seed: each level has about one in NEIGHBOURS of the vectors of the one below.
        self.level = np.minimum((-np.log(np.random.default_rng(n).random(n)) / np.log(NEIGHBOURS)).astype(int), 6)
        if n:
            self.level[0] = self.level.max()
        self.links = [np.full((n, LOWEST if lv == 0 else NEIGHBOURS), -1, np.int32) for lv in range(int(self.level.max(initial=0)) + 1)]
        at = 1
        while at < n:
            size = min(max(1, at // 2), 128, n - at)
            self._insert(np.arange(at, at + size))
            at += size

    def _insert(self, new: np.ndarray) -> None:
        """Vectors that come together see those before them by search and each other directly."""
        before = int(new[0])
        entry = np.zeros(len(new), np.int64)
        for lv in range(len(self.links) - 1, -1, -1):
            mine = self.level[new] >= lv
            near, close = self._beam(self.unit[new], entry, lv, BUILD_BEAM if mine.any() else 1)
            entry = near[:, 0]
            if not mine.any():
                continue
            own = new[mine]
            mates = self.unit[own] @ self.unit[own].T
            np.fill_diagonal(mates, -2)
            all_near = np.concatenate([near[mine], np.broadcast_to(own, (len(own), len(own)))], axis=1)
            all_close = np.concatenate([close[mine], mates], axis=1)
            width = self.links[lv].shape[1]
            order = np.argsort(-all_close, axis=1, kind="stable")[:, : 2 * width]
            for k, node in enumerate(own.tolist()):
                chosen = self._spread(all_near[k][order[k]], all_close[k][order[k]], width // 2)
                self.links[lv][node, : len(chosen)] = chosen
                for other in chosen.tolist():
                    self._link(lv, other, node)
        assert before > 0

    def _spread(self, near: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        """Neighbours that are nearer to the vector than to one chosen before; then the nearest of the others."""
        real = (near >= 0) & (close > -2)
        near, close = near[real], close[real]
        if len(near) <= most:
            return near
        among = self.unit[near] @ self.unit[near].T
        chosen: list[int] = []
        for k in range(len(near)):
            if len(chosen) == most // 2 + 1:
                break
            if not chosen or close[k] > among[k, chosen].max():
                chosen.append(k)
        rest = [k for k in range(len(near)) if k not in chosen]
        return near[np.array(chosen + rest[: most - len(chosen)])]

    def _link(self, lv: int, node: int, other: int) -> None:
        row = self.links[lv][node]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        around = np.append(row, other)
        close = self.unit[around] @ self.unit[node]
        order = np.argsort(-close, kind="stable")
        kept = self._spread(around[order], close[order], len(row))
        row[:] = -1
        row[: len(kept)] = kept

    def _beam(self, queries: np.ndarray, entry: np.ndarray, lv: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best vectors met on a level, for all queries side by side; missing ones are -1."""
        n, links = len(queries), self.links[lv]
        near, close = np.full((n, beam), -1, np.int64), np.full((n, beam), -2.0)
        done = np.zeros((n, beam), bool)
        near[:, 0], close[:, 0] = entry, (queries * self.unit[entry]).sum(1)
        seen = np.zeros((n, len(self.unit)), bool)
        seen[np.arange(n), entry] = True
        going = np.arange(n)
        while len(going):
            left = ~done[going] & (near[going] >= 0)
            going = going[left.any(1)]
            if not len(going):
                break
            at = (~done[going] & (near[going] >= 0)).argmax(1)  # beams are in order, so this is the best one left
            done[going, at] = True
            around = links[near[going, at]]
            fresh = around >= 0
            fresh &= ~seen[going[:, None], around]
            i, j = np.nonzero(fresh)
            if not len(i):
                continue
            seen[going[i], around[i, j]] = True
            scores = np.full(around.shape, -2.0)
            scores[i, j] = np.einsum("ij,ij->i", queries[going[i]], self.unit[around[i, j]])
            all_close = np.concatenate([close[going], scores], axis=1)
            order = np.argsort(-all_close, axis=1, kind="stable")[:, :beam]
            close[going] = np.take_along_axis(all_close, order, 1)
            near[going] = np.take_along_axis(np.concatenate([near[going], np.where(fresh, around, -1)], axis=1), order, 1)
            done[going] = np.take_along_axis(np.concatenate([done[going], ~fresh], axis=1), order, 1)
        return near, close

    def both_ways(self) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours on the lowest level in either direction, so that no vector is without a way to it."""
        if self._both is None:
            n, (u, k) = len(self.unit), np.nonzero(self.links[0] >= 0)
            v = self.links[0][u, k].astype(np.int64)
            pairs = np.unique(np.concatenate([u * n + v, v * n + u]))
            self._both = np.searchsorted(pairs, np.arange(n + 1) * n), pairs % n
        return self._both

    def nearest(self, queries: np.ndarray, beam: int, own: np.ndarray) -> np.ndarray:
        """For each query the closeness of the nearest vector that a beam meets, but for the query's ``own`` place (-1: none)."""
        near, close = self._beam(queries, self._entry(queries), 0, beam)
        return np.where((near >= 0) & (near != own[:, None]), close, -2).max(1)

    def _entry(self, queries: np.ndarray) -> np.ndarray:
        """Where a search of the lowest level begins."""
        entry = np.zeros(len(queries), np.int64)
        for lv in range(len(self.links) - 1, 0, -1):
            entry = self._beam(queries, entry, lv, 1)[0][:, 0]
        return entry

    def audited_beam(self, queries: np.ndarray, own: np.ndarray, threshold: float) -> int:
        """The narrowest beam that does for each of ``queries``; ``own`` is the place of each in the shard, -1 if it has none."""
        scores = queries @ self.unit.T
        scores[np.flatnonzero(own >= 0), own[own >= 0]] = -2
        truth = [np.flatnonzero(row >= threshold) for row in scores]
        lone = np.array([k for k, t in enumerate(truth) if not len(t)], np.int64)
        if len(queries) - len(lone) >= LINKED:
            lone = lone[:0]
        beam = BEAM
        while beam < len(self.unit):
            got = self.search(queries, threshold, beam)
            if all(len(np.intersect1d(a, b, assume_unique=True)) >= AUDIT * len(b) for a, b in zip(got, truth, strict=True)):
                # Equal but for the rounding of a product of matrices and one of vectors.
                if not len(lone) or (self.nearest(queries[lone], beam, own[lone]) >= scores[lone].max(1) - 1e-9).all():
                    return beam
            beam = 2 * beam if 2 * beam <= WIDEST else len(self.unit)
        return beam

    def search(self, queries: np.ndarray, threshold: float, beam: int) -> list[np.ndarray]:
        """For each query the vectors found at ``threshold`` or above, in order."""
        if beam >= len(self.unit):
            return [np.flatnonzero(row >= threshold) for row in queries @ self.unit.T]
        first, around_all = self.both_ways()
        near, close = self._beam(queries, self._entry(queries), 0, beam)
        out = []
        for q, some, scores in zip(queries, near, close, strict=True):
            lead = some[scores >= threshold - SLACK]
            found = [some[scores >= threshold]]
            if len(lead):
                met = np.zeros(len(self.unit), bool)
                met[some[some >= 0]] = True
                while len(lead):
                    around = np.unique(np.concatenate([around_all[first[v] : first[v + 1]] for v in lead.tolist()]))
                    around = around[~met[around]]
                    met[around] = True
                    scores = self.unit[around] @ q
                    found.append(around[scores >= threshold])
                    lead = around[scores >= threshold - SLACK]
            out.append(np.unique(np.concatenate(found)))
        return out


def _unit(column) -> np.ndarray:
    """Packed doubles to unit vectors; the largest component is divided out first, so that no square overflows."""
    x = np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    graph = Graph(_unit(rows["values"]))
    links = [g.astype("<i4").tobytes() for g in graph.links]
    return pd.DataFrame([{
        "label": key[0], "width": key[1], "shard": key[2], "nodes": rows["node"].to_numpy("<i8").tobytes(), "copies": rows["copies"].to_numpy("<i8").tobytes(),
        "vectors": graph.unit.tobytes(), "links": links,
    }])


_GRAPH = "label int, width int, shard long, nodes binary, copies binary, vectors binary, links array<binary>"


def _loaded(row) -> Graph:
    graph = Graph.__new__(Graph)
    graph._both = None
    n = len(row["nodes"]) // 8
    graph.unit = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
    graph.links = [np.frombuffer(g, "<i4").reshape(n, -1) for g in row["links"]]
    return graph


def _query(threshold: float):
    """A block of queries against one shard."""

    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        columns = ["node", "n_links", "other"]
        if not len(queries) or not len(shard):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        row = shard.iloc[0]
        graph, nodes, copies = _loaded(row), np.frombuffer(row["nodes"], "<i8"), np.frombuffer(row["copies"], "<i8")
        queries = queries.sort_values("node")
        unit, own = _unit(queries["values"]), queries["node"].to_numpy()
        audited = np.linspace(0, len(unit) - 1, min(AUDITED, len(unit))).astype(int)
        place = {node: k for k, node in enumerate(nodes.tolist())}
        beam = graph.audited_beam(unit[audited], np.array([place.get(node, -1) for node in own[audited].tolist()], np.int64), threshold)
        found = [f for at in range(0, len(unit), _TOGETHER) for f in graph.search(unit[at : at + _TOGETHER], threshold, beam)]
        # Verified once more, the same way for every query; a class does not link with itself here.
        kept = []
        for q, node, some in zip(unit, own, found, strict=True):
            some = some[graph.unit[some] @ q >= threshold]
            kept.append(some[nodes[some] != node])
        counts = np.array([int(copies[some].sum()) for some in kept])

        # Components of this block: labels fall to the smallest along all links at once.
        every = np.union1d(nodes, own)
        label, mine, theirs = np.arange(len(every)), np.searchsorted(every, own), np.searchsorted(every, nodes)
        sizes = np.array([len(s) for s in kept])
        flat = theirs[np.concatenate(kept)] if sizes.sum() else np.empty(0, np.int64)
        owner = np.repeat(mine, sizes)
        while len(flat):
            low = np.minimum(label[owner], label[flat])
            new = label.copy()
            np.minimum.at(new, owner, low)
            np.minimum.at(new, flat, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(every)))
        return pd.concat([
            pd.DataFrame({"node": own[counts > 0], "n_links": counts[counts > 0], "other": -1}),
            pd.DataFrame({"node": every[moved], "n_links": 0, "other": every[label[moved]]}),
        ])

    return run


def classes_of(vectors: DataFrame) -> DataFrame:
    """row columns vec_id, label, node: rows that can link, with the number of their class (null for others)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "label", "embedding").withColumn("usable", F.coalesce(usable, F.lit(False)))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    rows = classes_of(vectors)
    # Minus zero equals zero; adding zero makes them one.
    same = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = land(rows.select("vec_id", F.when(F.col("usable"), F.col("label")).alias("label"), F.when(F.col("usable"), same).alias("embedding")), "rows")
    classes = rows.filter("label IS NOT NULL").groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low_id"))
    classes = land(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [v.values.to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for v in batch.column("embedding")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "width", "copies")), pa.array(packed, pa.binary())], names=["node", "label", "width", "copies", "values"])

    packed = classes.select("node", "label", F.size("embedding").alias("width"), "copies", "embedding").mapInArrow(pack, "node long, label int, width int, copies long, values binary")
    # One row per label and length of vectors.
    sizes = classes.groupBy("label", F.size("embedding").alias("width")).agg(F.ceil(F.count("*") / SHARD).alias("shards"), F.ceil(F.count("*") / QUERIES).alias("blocks"))
    dealt = packed.join(sizes, ["label", "width"])
    dealt = land(dealt.withColumn("shard", F.pmod(F.xxhash64("node"), "shards")).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks")), "dealt")

    graphs = land(dealt.groupBy("label", "width", "shard").applyInPandas(_build, _GRAPH), "graphs")
    keys = ["label", "width", "shard", "block"]
    asked = dealt.drop("shard").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    offered = graphs.join(sizes.select("label", "width", "blocks"), ["label", "width"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    found = asked.select(*keys, "node", "values").groupBy(*keys).cogroup(offered.drop("blocks").groupBy(*keys)).applyInPandas(_query(threshold), "node long, n_links long, other long")
    found = land(found, "found")

    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.filter("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "label", "embedding", "copies", "low_id").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = land(named, "named")
    lowest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    facts = named.join(lowest, "root").select("label", "embedding", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(facts, ["label", "embedding"], "left")
    component = F.when(F.col("label").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op3_embedding_near_dedup(vectors: DataFrame) -> DataFrame:
    """Every vector with the number of its links, its component and whether it is the one that stays."""
    return near_duplicates(vectors)
