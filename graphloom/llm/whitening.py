"""Whitening of embeddings: randomised range finder over all centred rows, Rayleigh-Ritz for the components.

Every pass multiplies the covariance of all rows with a thin basis, as one partial product a task. The driver holds
matrices of the dimension only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from graphloom.llm._util import PARTS, part_rows, summed

#: Components asked for, columns beside them, and power passes before the first Rayleigh-Ritz.
COMPONENTS, OVERSAMPLED, POWERS = 32, 8, 3
#: Largest residual |Vu - eu| of a component, as a share of the first eigenvalue, with which a basis is enough.
TOLERANCE = 1e-13
#: Below this share of the first eigenvalue, a direction has no variance.
NOTHING = 1e-12
#: The grid of the contract: entries are counted in 64ths, moved by a million. Magnitudes from 2**52 on are held there.
GRID, MOVED, MOST = 64, 1_000_000, 1 << 52


def on_grid(vec: Column) -> Column:
    """Entries as longs floor(64c) + 1000000."""
    return F.transform(vec, lambda c: (F.floor(F.least(F.greatest(c.cast("double") * GRID, F.lit(-float(MOST))), F.lit(float(MOST)))) + MOVED).cast("long"))


def usable(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Rows (row struct of all columns, x array<long>) whose vector isn't null and has no null, NaN or infinite entry.

    Vectors have the commonest length (of equally common ones the longest); empty ones and other lengths go as well.
    """
    vec = F.col(f"`{vec_col}`")
    fine = F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))), F.lit(False)) & (F.size(vec) > 0)
    rows = vectors.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row"), F.when(fine, vec).alias("vec")).filter("vec is not null")
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vec") == (common["d"] if common else 0)).select("row", on_grid(F.col("vec")).alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _over_rows(rows: DataFrame, part: Callable[[np.ndarray], list[np.ndarray]], shapes: list[tuple]) -> list[np.ndarray]:
    """Sums over all rows of the arrays that `part` makes of a batch's matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _matrices(batches):
            made = np.concatenate([np.ravel(a).astype(np.float64) for a in part(x)])
            total = made if total is None else total + made
        if total is not None:
            yield from part_rows(TaskContext.get().partitionId(), total)

    flat = summed(rows.select("x").mapInArrow(run, PARTS))
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [a.reshape(s) for a, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)]


@dataclass(frozen=True)
class Whitening:
    """n rows with the sums S; components as columns (d, k), eigenvalues falling; trace of the covariance.

    passed: how many columns the basis had that was enough.
    """

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passed: int

    def moved(self, x: np.ndarray) -> np.ndarray:
        """n*x - S as longs, exact while they fit."""
        low = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums])
        return self.n * (x - low) - rest

    def scale(self) -> np.ndarray:
        """Columns that whiten a centred row; zero for directions without variance."""
        e = self.eigenvalues
        real = e > NOTHING * max(float(e[0]), 0.0) if len(e) else np.zeros(0, dtype=bool)
        return self.components * np.where(real, 1 / np.sqrt(np.where(real, e, 1)), 0)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sums: Spark adds longs, one row a task and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, 0
        for x in _matrices(batches):
            n, s = n + len(x), s + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(s)), pa.int32()), pa.array([n, *s.tolist()], pa.int64())], names=["at", "s"])

    got = rows.select("x").mapInArrow(run, "at int, s bigint").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["at"]: int(r["s"]) for r in got}
    return by.pop(-1, 0), [by[i] for i in sorted(by)]


def fit(rows: DataFrame, k: int = COMPONENTS, seed: int = 5) -> Whitening | None:
    """Components of all rows (row, x). None without rows."""
    n, sums = _sums(rows)
    if n == 0:
        return None
    d, rng = len(sums), np.random.default_rng(seed)
    empty = Whitening(n, tuple(sums), np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    k, width = min(k, d), min(d, k + OVERSAMPLED)

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        """Covariance times q, and the covariance's trace."""
        def part(x: np.ndarray) -> list[np.ndarray]:
            c = empty.moved(x) / n
            return [c.T @ (c @ q), np.array([(c * c).sum()])]

        vq, trace = _over_rows(rows, part, [q.shape, (1,)])
        return vq / n, float(trace[0]) / n

    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    for _ in range(POWERS if width < d else 0):
        q = np.linalg.qr(times(q)[0])[0]
    while True:
        vq, trace = times(q)
        t = q.T @ vq
        e, u = np.linalg.eigh((t + t.T) / 2)
        e, u = e[::-1][:k], u[:, ::-1][:, :k]
        residual = np.linalg.norm(vq @ u - (q @ u) * e, axis=0)
        if q.shape[1] == d or residual.max() <= TOLERANCE * e[0]:
            return Whitening(n, tuple(sums), q @ u, np.maximum(e, 0), trace, q.shape[1])
        q = np.linalg.qr(np.hstack([q, rng.standard_normal((d, d - q.shape[1]))]))[0]


def identity_error(rows: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over directions with variance."""
    m, n = found.scale(), found.n
    k = m.shape[1]

    def whitened(x: np.ndarray) -> np.ndarray:
        return (found.moved(x) / n) @ m

    (total,) = _over_rows(rows, lambda x: [whitened(x).sum(axis=0)], [(k,)])
    mean = total / n

    def part(x: np.ndarray) -> list[np.ndarray]:
        c = whitened(x) - mean
        return [c.T @ c]

    (cov,) = _over_rows(rows, part, [(k, k)])
    real = np.any(m != 0, axis=0)
    gap = np.abs(cov / n - np.eye(k))[np.ix_(real, real)]
    return float(gap.max()) if gap.size else 0.0


def whiten(rows: DataFrame, found: Whitening) -> DataFrame:
    """row, deviation long (null beyond 64 bits), whitened array<double>; one row for each of rows."""
    m, n = found.scale(), found.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _matrices([batch], at=1):
                y = found.moved(x)
                if float(np.abs(y).max()) ** 2 * y.shape[1] < 2.0**62:
                    deviation = (y * y).sum(axis=1).tolist()
                else:
                    deviation = [v if (v := sum(a * a for a in r)) < 1 << 63 else None for r in y.tolist()]
                w = (y / n) @ m
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), values], names=["row", "deviation", "whitened"])

    schema = StructType([rows.schema["row"], StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    return rows.select("row", "x").mapInArrow(run, schema)


def components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    A repeated row counts and is returned as often as it stands, null ids stay. No usable vector: no rows. A direction
    without variance whitens to 0, explains 0 and is outside of identity_error. Vectors of fewer than k entries have
    as many components as entries.
    """
    rows = usable(vectors, vec_col)
    found = fit(rows, k)
    kind = vectors.schema[id_col].dataType.simpleString()
    if found is None:
        return vectors.sparkSession.createDataFrame([], f"{id_col} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    error = identity_error(rows, found)
    share = F.array(*[F.lit(float(e) / found.trace if found.trace > 0 else 0.0) for e in found.eigenvalues])
    each = whiten(rows, found).select(F.col(f"row.`{id_col}`").alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(id_col, (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
