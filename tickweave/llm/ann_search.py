"""Approximate nearest neighbours by balanced posting lists.

Vectors are mapped so that the largest inner product is the smallest Euclidean distance
(one more component, ``sqrt(longest^2 - |x|^2)``). Centroids come from balanced
k-means over a bounded sample; a graph over them is kept in memory and searched best first. Every
vector goes to its nearest list and, where it lies near a boundary, to further lists whose
centroid is hardly farther. How many lists a query searches is measured on the vectors at hand: up
to ``trial_queries`` queries are also answered by brute force, and the least width is taken whose lists hold
the share ``recall`` of those answers - all lists, if need be. Found vectors are ranked by their exact
inner product in double precision.

The only broadcast is the index: at most ``max_centroids`` centroids and their links. Lists stand
on shelves of about ``cell_rows`` vectors, to each of which a query is sent once. Lists grow with
the input beyond that, so a shelf is cut into cells of ``cell_rows`` vectors and ``cell_queries``
queries by hash; no task holds a whole list.

What a cell returns follows the answers, not the vectors it compares: a query first meets samples
of the vectors, each eight times the one before, in the lists it searches. Its ``k``-th best there
is a floor below which nothing can be among its ``k`` best, so a cell leaves such vectors out. A
query thus gets some ``8 k`` rows a sample and as many from all its lists, and the results are those without floors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise


@dataclass
class Index:
    """Centroids, their links, where searches start, and the length that lifts vectors."""

    centroids: np.ndarray
    links: np.ndarray
    starts: np.ndarray
    longest: float

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.longest**2 - (v * v).sum(axis=1), 0))
        return np.concatenate([v, more[:, None]], axis=1)

    def nearest(self, points: np.ndarray, width: int, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Best-first graph search for many points at once: (centroids, distances), nearest first."""
        width = min(width, len(self.centroids))
        if 128 * width >= len(self.centroids):  # measured: up to there all distances are cheaper than the graph, and exact
            found = [self._all(points[i : i + batch], width) for i in range(0, len(points), batch)]
        else:
            found = [self._search(points[i : i + batch], width) for i in range(0, len(points), batch)]
        if not found:
            return np.zeros((0, width), np.int64), np.zeros((0, width))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _all(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        gaps = np.maximum(_gaps(points, self.centroids), 0)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :width]
        return order, np.sqrt(np.take_along_axis(gaps, order, axis=1))

    def _search(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(points))
        room = max(width, len(self.starts))
        ids = np.full((len(points), room), -1)
        dist = np.full((len(points), room), np.inf)
        done = np.zeros((len(points), room), bool)

        def offer(live, new):
            near = ((points[live][:, None, :] - self.centroids[new]) ** 2).sum(axis=2)
            near[(new[:, :, None] == ids[live][:, None, :]).any(axis=2)] = np.inf
            d = np.concatenate([dist[live], near], axis=1)
            best = np.argpartition(d, room - 1, axis=1)[:, :room] if d.shape[1] > room else np.tile(np.arange(room), (len(live), 1))
            dist[live] = np.take_along_axis(d, best, axis=1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), best, axis=1)
            done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros_like(new, bool)], axis=1), best, axis=1)

        offer(rows, np.tile(self.starts, (len(points), 1)))
        live = rows
        while len(live):
            at = np.where(done[live] | ~np.isfinite(dist[live]), np.inf, dist[live]).argmin(axis=1)
            go = ~done[live, at] & np.isfinite(dist[live, at])
            live, at = live[go], at[go]
            if len(live):
                done[live, at] = True
                offer(live, self.links[ids[live, at]])
        order = np.argsort(dist, axis=1)[:, :width]
        return np.take_along_axis(ids, order, axis=1), np.sqrt(np.take_along_axis(dist, order, axis=1))


def _gaps(points: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of points to centroids."""
    return (points**2).sum(1)[:, None] - 2 * points @ c.T + (c**2).sum(1)[None, :]


def balanced_means(points: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 12, weight: float = 0.15) -> np.ndarray:
    """k-means whose assignments are charged for the size of a cluster, so that sizes stay close."""
    c = points[rng.choice(len(points), count, replace=False)].copy()
    load = np.full(count, len(points) / count)
    for _ in range(rounds):
        near = np.concatenate([(_gaps(points[i : i + 2048], c)).min(axis=1) for i in range(0, len(points), 2048)])
        charge = weight * max(float(np.median(near)), 1e-12) * (load / load.mean() - 1)
        own = np.concatenate([(_gaps(points[i : i + 2048], c) + charge[None, :]).argmin(axis=1) for i in range(0, len(points), 2048)])
        size = np.bincount(own, minlength=count)
        order = np.argsort(own, kind="stable")
        some = np.flatnonzero(size)
        sums = np.add.reduceat(points[order], np.concatenate(([0], np.cumsum(size)[:-1]))[some], axis=0)
        c[some] = sums / size[some][:, None]
        empty = np.flatnonzero(size == 0)
        c[empty] = points[rng.choice(len(points), len(empty))]
        load = 0.5 * load + 0.5 * size
    return c


def build_index(vectors: DataFrame, list_rows: int = 100, max_centroids: int = 4096, sample_rows: int = 20_000, degree: int = 16, seed: int = 7) -> Index | None:
    """An index over (id, v); None if there are no vectors.

    The sample, of about ``sample_rows`` rows at most, is chosen by a hash of the id.
    """
    n, longest = vectors.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    if not n:
        return None
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    frame = vectors.where(u < min(1.0, sample_rows / n)).select("id", F.col("v").cast("array<float>").alias("v")).toPandas().sort_values("id")
    index = Index(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int), float(longest))
    rng = np.random.default_rng(seed)
    points = index.lifted(np.stack(frame["v"].to_numpy()).astype(float), False) if len(frame) else None
    if points is None:  # a sample of a handful may come out empty
        points = index.lifted(np.stack([np.array(r.v) for r in vectors.orderBy("id").limit(1).collect()]), False)
    count = max(1, min(n // list_rows, max_centroids, len(points) // 4))
    c = balanced_means(points, count, rng)
    near = np.concatenate([np.argsort(_gaps(c[i : i + 512], c), axis=1, kind="stable")[:, 1 : degree + 1] for i in range(0, count, 512)])
    far = rng.integers(0, count, (count, max(1, degree // 4)))  # a few long links keep the graph connected
    links = np.sort(np.concatenate([near, far, np.roll(np.arange(count), 1)[:, None]], axis=1), axis=1)
    # A link that stands twice becomes one to the node itself, which a search knows already.
    links[:, 1:] = np.where(links[:, 1:] == links[:, :-1], np.arange(count)[:, None], links[:, 1:])
    index.centroids, index.links = c, links
    index.starts = np.unique(rng.choice(count, min(count, 8), replace=False))
    return index


def assign(batches: Iterator[pa.RecordBatch], index: Index, width: int, ratio: float, most: int) -> Iterator[pa.RecordBatch]:
    """(list, id, v, primary): the lists of each vector, ``most`` at most."""
    for batch, v in _points(batches):
        lists, dist = index.nearest(index.lifted(v, False), width)
        lists, dist = lists[:, :most], dist[:, :most]
        keep = (dist <= (1 + ratio) * dist[:, :1] + 1e-12) & np.isfinite(dist)
        # A third or later list is worth a copy only if its centroid is not nearer to one that has the vector.
        gap = np.linalg.norm(index.centroids[lists][:, :, None, :] - index.centroids[lists][:, None, :, :], axis=3)
        for j in range(2, lists.shape[1]):
            keep[:, j] &= ~((gap[:, j, :j] < dist[:, j : j + 1]) & keep[:, :j]).any(axis=1)
        row, col = np.nonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(lists[row, col].astype(np.int32)), batch.column("id").take(pa.array(row)), batch.column("v").take(pa.array(row)), pa.array(col == 0)], names=["list", "id", "v", "primary"])


def ask(batches: Iterator[pa.RecordBatch], index: Index, width: int, most: int, sizes: np.ndarray, enough: int) -> Iterator[pa.RecordBatch]:
    """(id, v, lists): the ``most`` lists that each query searches, and more until they hold ``enough`` vectors."""
    for batch, v in _points(batches):
        lists, dist = index.nearest(index.lifted(v, True), width)
        before = np.cumsum(sizes[lists], axis=1) - sizes[lists]
        keep = ((np.arange(lists.shape[1]) < most) | (before < enough)) & np.isfinite(dist)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), _arrays(lists[keep], keep.sum(axis=1))], names=["id", "v", "lists"])


def to_shelves(batches: Iterator[pa.RecordBatch], shelves: int) -> Iterator[pa.RecordBatch]:
    """A query's row once a shelf that has lists it searches, with those lists."""
    for batch in batches:
        lists = batch.column("lists")
        row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
        lists = lists.flatten().to_numpy()
        order = np.lexsort((lists % shelves, row))
        row, lists = row[order], lists[order]
        new = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(lists % shelves, prepend=-1))
        sent = [batch.column(n).take(pa.array(row[new])) for n in batch.schema.names if n != "lists"]
        names = [n for n in batch.schema.names if n != "lists"]
        yield pa.RecordBatch.from_arrays([pa.array((lists[new] % shelves).astype(np.int32)), *sent, _arrays(lists, np.diff(np.append(new, len(row))))], names=["shelf", *names, "lists"])


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in (part for whole in batches for part in (whole.slice(i, 512) for i in range(0, len(whole), 512))):
        yield batch, batch.column("v").flatten().to_numpy().reshape(len(batch), -1)


def _arrays(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values.astype(np.int32)))


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products, component after component in double precision, at any block shape alike."""
    out = np.zeros(np.broadcast_shapes(q.shape[:-1], v.shape[:-1]))
    for d in range(v.shape[-1]):
        out += q[..., d] * v[..., d]
    return out


def _brute(batches: Iterator[pa.RecordBatch], own: np.ndarray, q: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, id, score): the ``k`` nearest of a partition's vectors per query."""
    best, ids = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
    for batch in batches:
        new = batch.column("id").to_numpy()
        if not len(new):
            continue
        score = q @ batch.column("v").flatten().to_numpy().reshape(len(new), -1).T
        score[own[:, None] == new[None, :]] = -np.inf
        score, new = np.concatenate([best, score], axis=1), np.concatenate([ids, np.tile(new, (len(q), 1))], axis=1)
        at = np.argpartition(-score, k - 1, axis=1)[:, :k]
        best, ids = np.take_along_axis(score, at, axis=1), np.take_along_axis(new, at, axis=1)
    row, col = np.nonzero(best > -np.inf)
    yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(ids[row, col]), pa.array(best[row, col])], names=["query_id", "id", "score"])


def lists_needed(queries: DataFrame, vectors: DataFrame, posted: DataFrame, k: int, index: Index, recall: float, trial_queries: int) -> int:
    """The least number of lists, in steps of a quarter, that hold ``recall`` of the brute-force answers to some queries.

    The queries are chosen by a hash of the id. All vectors are read for them; each task keeps ``k`` a query.
    """
    count = len(index.centroids)
    trial = queries.orderBy(F.xxhash64("id"), "id").limit(trial_queries).toPandas()
    if not len(trial) or count == 1:
        return 1
    own, q = trial["id"].to_numpy(), np.stack(trial["v"].to_numpy())
    near = vectors.select("id", "v").mapInArrow(lambda it: _brute(it, own, q, k), "query_id long, id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    truth = near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "id")
    lists = posted.select("id", "list").join(F.broadcast(truth), "id").select("query_id", "id", "list").toPandas()
    if not len(lists):
        return 1
    row = pd.Index(own).get_indexer(lists["query_id"])
    points, width = index.lifted(q, True), min(4, count)
    while width < count:
        found = index.nearest(points, width)[0]
        held = (found[row] == lists["list"].to_numpy()[:, None]).any(axis=1)
        if held_share(lists, held) >= recall:
            break
        width = min(count, width + max(1, width // 4))
    return width


def held_share(lists: pd.DataFrame, held: np.ndarray) -> float:
    """The share of answers of which at least one list is searched."""
    return float(lists.assign(held=held).groupby(["query_id", "id"])["held"].any().mean())


def _cell(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, count: int) -> pd.DataFrame:
    """(query_id, id, score): per query the ``k`` best vectors in its lists that are no worse than its floor."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if len(queries) and len(vectors):
        vectors = vectors.sort_values(["list", "id"], ignore_index=True)
        ids, lists, v = vectors["id"].to_numpy(), vectors["list"].to_numpy(), np.stack(vectors["v"].to_numpy())
        name = np.unique(ids, return_inverse=True)[1]  # copies of a vector have one
        cuts = np.append(np.flatnonzero(np.diff(lists, prepend=-1)), len(lists))
        by_list = len(ids) >= 16 * (len(cuts) - 1)  # a sample has few vectors a list: all are compared, then masked
        runs = list(zip(cuts[:-1], cuts[1:], strict=True)) if by_list else [(0, len(ids))]
        for start in range(0, len(queries), 256):
            part = queries.iloc[start : start + 256]
            q, own = np.stack(part["v"].to_numpy()), part["id"].to_numpy()
            floor, last = part["floor"].to_numpy(), part["floor_id"].to_numpy()
            low = np.where(np.isfinite(floor), floor - _slack(floor), -np.inf)
            searched = np.zeros((len(part), count), bool)
            searched[np.repeat(np.arange(len(part)), part["lists"].map(len)), np.concatenate(part["lists"].to_numpy())] = True
            rows, at, rough = [], [], []
            for lo, hi in runs:
                some = np.flatnonzero(searched[:, lists[lo]]) if by_list else np.arange(len(part))
                near = q[some] @ v[lo:hi].T
                good = (near >= low[some, None]) & (own[some, None] != ids[None, lo:hi])
                if not by_list:
                    good &= searched[:, lists]
                i, j = np.nonzero(good)
                rows.append(some[i])
                at.append(lo + j)
                rough.append(near[i, j])
            rows, at, rough = (np.concatenate(x) for x in (rows, at, rough))
            once = np.unique(rows * len(ids) + name[at], return_index=True)[1]
            rows, at, rough = rows[once], at[once], rough[once]
            # Everything within rounding of a query's worst chosen is chosen, too, where ties go on.
            order = np.lexsort((-rough, rows))
            edge = np.full(len(part), -np.inf)
            full = order[_places(rows[order]) == k - 1]
            edge[rows[full]] = rough[full] - _slack(rough[full])
            keep = rough >= edge[rows]
            rows, at = rows[keep], at[keep]
            score = np.concatenate([np.zeros(0), *(exact_products(q[rows[i : i + 65536]], v[at[i : i + 65536]]) for i in range(0, len(rows), 65536))])
            keep = (score > floor[rows]) | ((score == floor[rows]) & (ids[at] <= last[rows]))
            rows, at, score = rows[keep], at[keep], score[keep]
            order = np.lexsort((ids[at], -score, rows))
            best = order[_places(rows[order]) < k]
            out.append((own[rows[best]], ids[at[best]], score[best]))
    a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"query_id": a, "id": b, "score": c})


def _slack(score: np.ndarray) -> np.ndarray:
    return 1e-9 * np.abs(score) + 1e-12


def _places(rows: np.ndarray) -> np.ndarray:
    """The place of each entry in its run of equal ``rows``, from 0."""
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    return np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): vectors in double precision, without null ids, nulls, non-finite components and zero vectors.

    Rows that repeat an id count once, with the smallest of their vectors. Where lengths differ,
    vectors of the most frequent length take part (of two, the shorter).
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    lengths = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    v = v.where(F.size("v") == (lengths["d"] if lengths else 1))
    return v.groupBy("id").agg(F.min("v").alias("v"))


def search(queries: DataFrame, vectors: DataFrame, k: int, index: Index | None, copies: int = 4, copy_ratio: float = 0.15, recall: float = 0.97, trial_queries: int = 256, cell_rows: int = 4096, cell_queries: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found per query, nearest first.

    Both inputs are (id, v) as ``usable`` makes them; a vector with the query's id is left out. Ties
    go to the smaller id. Each query searches as many lists as ``lists_needed`` measures for ``recall``. It gets ``k`` results
    (all others, if there are fewer): lists are searched until they hold more than ``k`` vectors.
    """
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    count = len(index.centroids)
    posted = materialise(vectors.mapInArrow(lambda it: assign(it, index, min(16, count), copy_ratio, copies), "list int, id long, v array<double>, primary boolean"))
    held = posted.groupBy("list").agg(F.count("*").alias("n"), F.count_if("primary").alias("p")).toPandas()
    sizes, rows = np.zeros(count, np.int64), np.zeros(count, np.int64)
    sizes[held["list"]], rows[held["list"]] = held["p"], held["n"]
    probes = lists_needed(queries, posted.where("primary"), posted, k, index, recall, trial_queries)
    width = probes if np.sort(sizes)[:probes].sum() > k else count  # enough vectors in any lists found
    asked = materialise(queries.mapInArrow(lambda it: ask(it, index, width, probes, sizes, k + 1), "id long, v array<double>, lists array<int>"))
    number = asked.count()
    own = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    schema = "query_id long, id long, score double"

    def meet(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(lambda a, b: _cell(a, b, k, count), schema)

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    asked = asked.select("*", F.lit(-np.inf).alias("floor"), F.lit(-1).cast("long").alias("floor_id"))
    share = 8
    while sizes.sum() > 4 * share * cell_rows:
        share *= 8
    while share > 1:
        sample = posted.where(F.col("primary") & (F.pmod(F.xxhash64("id", F.lit(share)), F.lit(share)) == 0))
        vc, qc = (F.lit(max(1, math.ceil(n))) for n in (sizes.sum() / share / cell_rows, number / cell_queries))
        found = meet(asked.select(own(qc).alias("q"), each(vc).alias("c"), *asked.columns), sample.select(each(qc).alias("q"), own(vc).alias("c"), "list", "id", "v"), ["q", "c"])
        floors = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"), F.col("id").alias("floor_id"))
        # A query that finds fewer than ``k`` in a sample keeps the floor it has.
        asked = asked.withColumnsRenamed({"floor": "f", "floor_id": "f_id"}).join(floors, "id", "left")
        asked = materialise(asked.select("id", "v", "lists", F.coalesce("floor", "f").alias("floor"), F.when(F.col("floor").isNull(), F.col("f_id")).otherwise(F.col("floor_id")).alias("floor_id")))
        share //= 8
    shelves = min(count, max(1, math.ceil(rows.sum() / cell_rows)))
    asked = asked.mapInArrow(lambda it: to_shelves(it, shelves), "shelf int, id long, v array<double>, floor double, floor_id long, lists array<int>")
    asks = asked.groupBy("shelf").count().toPandas()
    cells = pd.DataFrame({"shelf": np.arange(shelves), "vc": np.bincount(np.arange(count) % shelves, rows, shelves), "qc": 0})
    cells.loc[asks["shelf"], "qc"] = asks["count"].to_numpy()
    cells["vc"], cells["qc"] = (np.maximum(1, np.ceil(cells[n] / per)).astype(int) for n, per in (("vc", cell_rows), ("qc", cell_queries)))
    several = cells[(cells["vc"] > 1) | (cells["qc"] > 1)]
    table = {int(a): (int(b), int(c)) for a, b, c in several.itertuples(index=False)}
    vc, qc = (F.coalesce(F.create_map(*(F.lit(x) for a, t in table.items() for x in (a, t[i])))[F.col("shelf")], F.lit(1)) if table else F.lit(1) for i in (0, 1))
    left = asked.select("shelf", own(qc).alias("q"), each(vc).alias("c"), "id", "v", "floor", "floor_id", "lists")
    right = posted.withColumn("shelf", F.col("list") % shelves).select("shelf", each(qc).alias("q"), own(vc).alias("c"), "list", "id", "v")
    found = meet(left, right, ["shelf", "q", "c"]).distinct()  # copies of a vector have one score
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
