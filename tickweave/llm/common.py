"""What several operators share: lineage cuts, vectorised words, components, scoped settings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import cut_lineage

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHUNK = 2 << 20
_PIECE = 1 << 20


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the jobs inside the block only (``__`` stands for a dot)."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Texts in an Arrow batch: both sides of the pipe hold some of them at a time.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand texts to Python in batches of ``BATCH_ROWS``; a session setting, as plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def materialise(df: DataFrame) -> DataFrame:
    """``df`` kept by a reliable checkpoint; the shuffle files that made it are released."""
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return cut_lineage(df.select("*"))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash step and of its inverse modulo 2^64, grown on demand."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for step in (_STEP, _STEP_INVERSE):
            a = np.full(n, step, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        _powers = (made[0], made[1])
    return _powers


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``data[start:end]``; runs ascend and do not overlap.

    Works through pieces of a few MB, so a text of any length needs bounded memory
    besides the positions themselves.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        piece = data[base : ends[j - 1]].astype(np.uint64) + np.uint64(1)
        up, down = powers(len(piece) + 1)
        piece *= up[: len(piece)]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece, out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


@dataclass
class Texts:
    """Some texts as one buffer of UTF-8; ``bounds`` has one more entry than texts."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of some texts: hash and place of each, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The UTF-8 of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0])


def word_bounds(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word's index of every text (and the end)."""
    data, bounds = texts.data, texts.bounds
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SEPARATOR[data]
    begins = inside[1:-1] & ~inside[:-2]
    finish = inside[1:-1] & ~inside[2:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # texts touch in the buffer, words do not
    begins[cuts] |= inside[1:-1][cuts]
    finish[cuts - 1] |= inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def words_of(texts: Texts, lower: bool = True) -> Words:
    """Words of the texts, hashed; ``lower`` maps A-Z to a-z first."""
    starts, ends, first = word_bounds(texts)
    data = _LOWER[texts.data] if lower else texts.data
    return Words(run_hashes(data, starts, ends), starts, ends, first)


def in_chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = _CHUNK) -> Iterator[tuple[pa.Table, Texts]]:
    """Rows with their texts, in runs of about ``size`` bytes (one row at least)."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(texts.bounds, texts.bounds[i] + size, "right")) - 1)
            part = texts.bounds[i : j + 1]
            yield table.slice(i, j - i), Texts(texts.data[part[0] : part[-1]], part - part[0])
            i = j
        del table, texts
    pa.default_memory_pool().release_unused()  # a worker lives on; what its task has freed goes back


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, …`` of many runs after each other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node that undirected ``edges`` (a, b) reach from each node.

    Alternates large-star and small-star steps (Kiveris et al. 2014): edges only ever
    move to smaller nodes, their number never grows, and the rounds are logarithmic in
    the diameter. A node with many edges is split by the skew join.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    known = state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialise(small.where("a <> b").distinct())
        now = state(edges)
        if now == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        known = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def bit_of(column: str, bits: int):
    return F.pmod(F.xxhash64(column), F.lit(bits))


def bitmap(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of hashed ids as 64-bit words: ``bits`` in all, at any size of input."""
    bit = ids.select(bit_of(column, bits).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def split_by_ids(rows: DataFrame, ids: DataFrame, row_id: str, column: str, bits: int = 1 << 25) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may and that surely do not have an id of ``ids``; only the first need a join.

    Wide rows whose id is not listed are thus never shuffled. The bitmap's size is fixed;
    where it fills up, more rows go the longer way. Null ids count like any other.
    """
    marks = bitmap(ids, column, bits)

    @F.pandas_udf("boolean")
    def listed(bit: pd.Series) -> pd.Series:
        at = bit.to_numpy(np.int64)
        return pd.Series(((marks[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) > 0)

    hit = listed(bit_of(row_id, bits))
    return rows.where(hit), rows.where(~hit)
