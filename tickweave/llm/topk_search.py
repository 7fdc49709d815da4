"""Exact top-k by exhaustive term-at-a-time accumulation over blocks of rows.

Rows are sparse: an array of terms and an array of integer weights. Candidates are dealt into
blocks, queries into groups; each (block, group) cell inverts its candidates into postings,
and every query scatters its weighted postings into a dense score array with a place per
candidate. The k best of a cell are chosen by partition selection, and the cells of a query
are merged by rank. Nothing is pruned, so the result is exact.

A cell holds ``block_rows`` candidates and ``group_rows`` queries at most on average; a
candidate is sent once per query group and a query once per candidate block, as in a blocked
matrix product. Blocks follow a hash of the id, so no key makes a block large.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sparse(vector: Column) -> tuple[Column, Column]:
    """(terms, weights) of an array of integers: the positions that are not zero."""
    at = F.filter(F.transform(vector, lambda x, i: F.when(x != 0, F.struct(i.alias("t"), x.alias("w")))), lambda p: p.isNotNull())
    return at["t"], at["w"]


def _flat(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = frame["terms"].map(len).to_numpy(np.int64) if len(frame) else np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(frame)), sizes)
    join = lambda c: np.concatenate([np.asarray(x) for x in frame[c]]).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    return rows, join("terms"), join("weights")


def postings(frame: pd.DataFrame) -> dict[int, tuple[np.ndarray | slice, np.ndarray]]:
    """Term -> (rows, weights); a term that all rows have is a slice over all of them."""
    rows, terms, weights = _flat(frame)
    order = np.argsort(terms, kind="stable")
    terms, rows, weights = terms[order], rows[order], weights[order]
    cut = np.flatnonzero(np.diff(terms, prepend=terms[:1] - 1)) if len(terms) else []
    out = {}
    for lo, hi in zip(cut, np.append(cut[1:], len(terms)), strict=True) if len(terms) else ():
        out[int(terms[lo])] = (slice(None) if hi - lo == len(frame) else rows[lo:hi], weights[lo:hi])
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, largest first, ties to the earlier place."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        places = np.concatenate((above, np.flatnonzero(scores == edge)[: k - len(above)]))
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((places, -scores[places]))]


def _cell(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    queries, candidates = (f.sort_values("id", ignore_index=True) for f in (queries, candidates))
    out: list[tuple[np.ndarray, ...]] = []
    if len(queries) and len(candidates):
        index, ids = postings(candidates), candidates["id"].to_numpy()
        for query, terms, weights in zip(queries["id"], queries["terms"], queries["weights"], strict=True):
            scores = np.zeros(len(candidates), np.int64)
            for term, weight in zip(np.asarray(terms).tolist(), np.asarray(weights).tolist(), strict=True):
                if term in index:
                    rows, values = index[term]
                    scores[rows] += weight * values
            own = np.searchsorted(ids, query)
            if own < len(ids) and ids[own] == query:
                others = np.delete(np.arange(len(ids)), own)
                places = others[best(scores[others], k)]
            else:
                places = best(scores, k)
            out.append((np.full(len(places), query), ids[places], scores[places]))
    q, v, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    return pd.DataFrame({"query_id": q, "id": v, "score": s})


def top_k(queries: DataFrame, candidates: DataFrame, k: int, block_rows: int = 4096, group_rows: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` candidates of the highest inner product per query.

    Both inputs are (id long, terms array<int>, weights array<bigint>) without nulls and with
    one row per id; ties go to the smaller id, and a candidate with the query's id is left out.
    A query without terms, and a candidate without common terms, scores 0 and is ranked too.
    """
    blocks = max(1, math.ceil(candidates.count() / block_rows))
    groups = max(1, math.ceil(queries.count() / group_rows))
    of = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select(of(groups).alias("g"), all_of(blocks).alias("b"), "id", "terms", "weights")
    c = candidates.select(of(blocks).alias("b"), all_of(groups).alias("g"), "id", "terms", "weights")
    found = q.groupBy("b", "g").cogroup(c.groupBy("b", "g")).applyInPandas(lambda a, b: _cell(a, b, k), "query_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, terms, weights) of dense vectors, components floored after scaling.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    Rows that repeat an id count once, with the smallest of their vectors.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    v = v.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"))
    v = v.groupBy("id").agg(F.min("v").alias("v"))
    terms, weights = sparse(F.col("v"))
    return v.select("id", terms.alias("terms"), weights.alias("weights"))
