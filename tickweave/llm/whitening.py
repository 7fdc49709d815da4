"""Embedding whitening: principal components from a blockwise QR, never from the covariance.

Vectors become integers first, so counts, sums and squared deviations are exact. Every task
centres its rows and folds them, block by block, into one triangular factor R of d x d; the
factors of the tasks are folded in rounds of sixteen. The last R goes through ``bidiagonal``
for singular values and right vectors: squares of entries are never summed, so small
components keep their digits. Whitened rows are one more pass, with a d x k matrix.

What reaches the driver or a task as a whole is d x d numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bidiagonal
from .common import materialise

#: Factors folded into one in a round.
FAN_IN = 16

#: Scaled entries beyond this leave exact arithmetic; such vectors count as non-finite.
LARGEST = float(1 << 40)


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, integer sums by dimension, directions over deviations, variances."""

    n: int
    sums: tuple[int, ...]
    weights: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total if len(self.variances) else self.variances

    def split_sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole means and remainders: ``sums = n * whole + rest`` with ``0 <= rest < n``."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * m for s, m in zip(self.sums, whole, strict=True)], np.int64)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(id, x): ``floor(scale * c) + offset`` of every entry, of the vectors that take part.

    Null vectors and those with null or non-finite entries (or beyond 2^40 once scaled) do not.
    Where lengths differ, those of the most frequent length take part, the
    shorter of two equally frequent ones; vectors without entries never do.
    """
    v = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale >= LARGEST))
    v = v.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    lengths = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    v = v.where(F.size("v") == (lengths["d"] if lengths else 1))
    return v.select("id", F.transform("v", lambda c: F.floor(c * float(scale)).cast("long") + offset).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(batch), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, sums = 0, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums), pa.array([rows] * len(sums), pa.int64())], ["dim", "s", "n"])

    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch)
        sums = x.sum(0) if sums is None else sums + x.sum(0)
        rows += len(x)
        if rows > 1 << 20:  # entries below 2^41 sum to less than 2^63
            yield done()
            rows, sums = 0, None
    if rows:
        yield done()


def _centred(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(np.float64) - rest / n


def _packed(group: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([values.tobytes()], pa.binary())], ["part", "r"])


def _fold(r: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block if r is None else np.vstack((r, block)), mode="r")


def _in_rounds(parts: DataFrame, combine, shape: tuple[int, ...]) -> list[np.ndarray]:
    """Arrays of one shape, a row each, combined ``FAN_IN`` at a time until few are left; those."""
    parts = materialise(parts)
    left = parts.count()
    while left > FAN_IN:
        groups = -(-left // FAN_IN)

        def fold(frame: pd.DataFrame) -> pd.DataFrame:
            made = combine([np.frombuffer(r).reshape(shape) for r in frame.sort_values("part")["r"]])
            return pd.DataFrame({"part": [int(frame["part"].min())], "r": [made.tobytes()]})

        parts = materialise(parts.groupBy((F.col("part") % groups).alias("g")).applyInPandas(fold, "part long, r binary"))
        left = parts.count()
    rows = sorted(parts.collect(), key=lambda row: row["part"])
    return [np.frombuffer(row["r"]).reshape(shape) for row in rows]


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def fit(rows: DataFrame, components: int = 32) -> Whitening:
    """The leading components of the rows of ``usable``, numbered by falling variance.

    Components without variance are left out, so a table of one row, or of equal rows, has none.
    """
    sums = rows.mapInArrow(_sums, "dim int, s long, n long").groupBy("dim")
    sums = sums.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    if not sums:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    n, d = sums[0]["n"], len(sums)
    model = Whitening(n, tuple(int(s["s"]) for s in sums), np.zeros((d, 0)), np.zeros(0), 0.0)
    whole, rest = model.split_sums()

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if len(batch):
                r = _fold(r, _centred(_matrix(batch), n, whole, rest))
        if r is not None:
            square = np.zeros((d, d))
            square[: len(r)] = r
            yield _packed(_task(), square)

    factors = _in_rounds(rows.mapInArrow(factor, "part long, r binary"), lambda rs: np.linalg.qr(np.vstack(rs), mode="r"), (d, d))
    r = np.linalg.qr(np.vstack(factors), mode="r")
    squares, directions = bidiagonal.leading(r, min(components, d))
    variances = squares / n
    return Whitening(n, model.sums, directions / np.sqrt(variances), variances, float(np.sum(r**2)) / n)


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sums over dimensions of ``(n * x - sums)^2`` without rounding; null beyond a long."""
    y = x - whole
    most = int(np.max(np.abs(y), initial=0)) + 1
    if len(whole) * max(most, n) * most < 1 << 62:
        a, b = (y * y).sum(1).tolist(), (y * rest).sum(1).tolist()
    else:
        wide = y.astype(object)
        a, b = (wide * wide).sum(1).tolist(), (wide * rest.astype(object)).sum(1).tolist()
    c = sum(v * v for v in rest.tolist())
    exact = [n * n * p - 2 * n * q + c for p, q in zip(a, b, strict=True)]
    return [v if v < 1 << 63 else None for v in exact]


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Each task keeps count, means and centred products and merges batches by the difference
    of their means; null without components.
    """
    k = model.weights.shape[1]
    if not k:
        return None
    whole, rest = model.split_sums()
    shape = (k + 2, k)

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        out = parts[0].copy()
        for part in parts[1:]:
            a, b = out[0, 0], part[0, 0]
            gap = part[1] - out[1]
            out[2:] += part[2:] + np.outer(gap, gap) * (a * b / (a + b))
            out[1] += gap * (b / (a + b))
            out[0] += part[0]
        return out

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if len(batch):
                z = _centred(_matrix(batch), model.n, whole, rest) @ model.weights
                mean = z.mean(0)
                part = np.vstack((np.full((1, k), float(len(z))), mean, (z - mean).T @ (z - mean)))
                state = part if state is None else merged([state, part])
        if state is not None:
            yield _packed(_task(), state)

    state = merged(_in_rounds(rows.mapInArrow(moments, "part long, r binary"), merged, shape))
    return float(np.max(np.abs(state[2:] / model.n - np.eye(k))))


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened array<double>): every row of ``usable`` on the model's components."""
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, deviation long, whitened array<double>"
    if not model.n:
        return rows.sparkSession.createDataFrame([], schema)
    whole, rest = model.split_sums()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            z = _centred(x, model.n, whole, rest) @ model.weights
            places = pa.array(np.arange(len(x) + 1, dtype=np.int32) * z.shape[1])
            lists = pa.ListArray.from_arrays(places, pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviations(x, model.n, whole, rest), pa.int64()), lists], ["id", "deviation", "whitened"])

    return rows.mapInArrow(project, schema)


def whitened_components(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    All usable vectors are the fit list. Rows with a null or repeated id, and repeated rows,
    count like any other; rows without a usable vector give nothing (see ``usable``), nor does a
    table that is empty or without variance. A ``deviation`` beyond a long is
    null. Other columns are not looked at.
    """
    rows = usable(vectors, id_col, vector_col)
    model = fit(rows, components)
    error = identity_error(rows, model)
    out = whiten(rows, model)
    shares = F.array(*map(F.lit, model.explained.tolist())) if len(model.variances) else F.lit(None).cast("array<double>")
    out = out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
