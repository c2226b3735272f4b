"""Embedding whitening: blockwise QR of the centred rows, bidiagonal qd solver, projection of every row.

Entries are put on a grid of whole numbers, so equal vectors can be told exactly and sums are
exact. The model is fitted on each distinct vector once: every task reduces its centred vectors block
by block to one triangle, triangles are stacked and reduced in groups of ``FAN`` until one is
left (d x d, whatever the number of vectors), and its singular values and right vectors (see ``bidiagonal``)
give the directions of the covariance without ever forming it.

Defined results: rows whose vector is null or holds null or non-finite entries are left out, empty
tables give no rows. The dimension is the length of most vectors (ties: the longer); a vector of another length is not fitted on
and gets null ``deviation`` and ``whitened``; vectors without entries give no rows where that is the commonest length.
Components without variance have null ``whitened``. Entries beyond ``LARGEST`` are held there, and a ``deviation`` that no
long can hold is null. Repeated rows and null ids are kept, each a row of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.bidiagonal import right_vectors
from marlstone.llm.common import staged

#: The grid: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond are held there, so that the grid fits longs.
LARGEST = 1.44e17
COMPONENTS = 16
#: Triangles reduced to one at a time; rows of a block, at least.
FAN, BLOCK_ROWS = 16, 2048


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers for finite doubles."""
    return np.floor(SCALE * np.clip(vectors, -LARGEST, LARGEST)).astype(np.int64) + OFFSET


def grid_rows(table: DataFrame, vector: str, keep: str) -> DataFrame:
    """Columns ``keep`` (long) and x (binary, the vector as longs) of the rows with a usable vector."""

    def convert(batches):
        for batch in batches:
            column = batch.column("vector")
            sizes = np.asarray(column.value_lengths().fill_null(0))
            values = column.flatten()
            usable = np.asarray(column.is_valid())
            good = np.asarray(values.is_valid()) & np.isfinite(np.asarray(values.fill_null(0.0)))
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~good)))
            usable &= bad[ends] == bad[ends - sizes]
            x = on_grid(np.where(good, np.asarray(values.fill_null(0.0)), 0.0))
            rows = np.flatnonzero(usable)
            encoded = [x[ends[k] - sizes[k] : ends[k]].tobytes() for k in rows]
            yield pa.RecordBatch.from_arrays([batch.column("keep").take(pa.array(rows)), pa.array(encoded, pa.binary())], ["keep", "x"])

    columns = table.select(F.col(keep).cast("long").alias("keep"), F.col(vector).cast("array<double>").alias("vector"))
    return columns.mapInArrow(convert, "keep long, x binary").withColumnRenamed("keep", keep)


def _stacked(column: pa.Array) -> np.ndarray:
    """Vectors of one length, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), -1)


def _roomy(x: np.ndarray, times: int) -> np.ndarray:
    """``x``, as Python integers where ``times`` its largest entry might exceed a long."""
    return x if float(np.abs(x.astype(float)).max(initial=0)) * times < 2.0**62 else x.astype(object)


@dataclass
class Model:
    """Distinct vectors ``n``, their exact ``sums``, eigenvalues, whitening directions (as columns) and figures."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        x = _roomy(x, 2 * self.n)
        return x * self.n - (self.sums if x.dtype == object else self.sums.astype(np.int64))

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ self.directions


def squared_lengths(centred: np.ndarray) -> list[int]:
    """Sum of squares per row, exactly."""
    largest = float(np.abs(centred.astype(float)).max(initial=0))
    return (_roomy(centred, int(largest) * centred.shape[1] + 1) ** 2).sum(axis=1).tolist()


def _sums(fit: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sum per dimension."""

    def add(batches):
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _stacked(batch.column("x"))
            n += len(x)
            total = total + _roomy(x, len(x) + 1).sum(axis=0).astype(object)
        rows = [str(t) for t in [*total, n]]
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(rows)], ["position", "total"])

    per_task = fit.mapInArrow(add, "position int, total string")
    totals = per_task.groupBy("position").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).toArrow()
    totals = dict(zip(totals["position"].to_pylist(), totals["total"].to_pylist()))
    return int(totals.get(size, 0)), np.array([int(totals.get(k, 0)) for k in range(size)], object)


def _reduced(*parts: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _triangle(fit: DataFrame, model: Model, size: int) -> np.ndarray:
    """R of the centred vectors' QR decomposition."""

    def reduce_rows(batches):
        r, waiting, rows = np.empty((0, size)), [], 0
        for batch in batches:
            waiting.append(model.centred(_stacked(batch.column("x"))).astype(float) / model.n)
            rows += len(waiting[-1])
            if rows >= max(BLOCK_ROWS, 4 * size):
                r, waiting, rows = _reduced(r, *waiting), [], 0
        r = _reduced(r, *waiting) if waiting else r
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()])], ["part", "r"])

    def reduce_group(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        parts = [np.frombuffer(r, float).reshape(-1, size) for r in group["r"].to_pylist()]
        return pa.table({"part": pa.array([group["part"][0].as_py() // FAN], pa.int64()), "r": pa.array([_reduced(*parts).tobytes()])})

    triangles = staged(fit.mapInArrow(reduce_rows, "part long, r binary"), "triangles")
    last = triangles.agg(F.max("part")).first()[0]
    while last:
        triangles = triangles.groupBy(F.expr(f"part div {FAN}")).applyInArrow(reduce_group, "part long, r binary")
        last //= FAN
    r = np.frombuffer(triangles.first().r, float).reshape(-1, size)
    return np.concatenate([r, np.zeros((size - len(r), size))])


def _identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    used = model.directions.shape[1]

    def multiply(batches):
        total = np.zeros((used, used + 1))
        for batch in batches:
            w = model.whitened(model.centred(_stacked(batch.column("x"))))
            total += w.T @ np.concatenate([w, np.ones((len(w), 1))], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["position", "total"])

    totals = fit.mapInArrow(multiply, "position int, total double").groupBy("position").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(used * (used + 1))
    total[totals["position"].to_numpy()] = totals["total"].to_numpy()
    total = total.reshape(used, used + 1) / model.n
    mean = total[:, -1]
    return float(np.abs(total[:, :-1] - np.outer(mean, mean) - np.eye(used)).max(initial=0))


def fit_model(rows: DataFrame, size: int, components: int = COMPONENTS) -> Model:
    """The whitening of ``rows`` (x), their vectors of ``size`` entries, each distinct one once."""
    fit = staged(rows.where(F.length("x") == 8 * size).select("x").distinct(), "vectors")
    n, sums = _sums(fit, size)
    model = Model(n, sums, np.empty(0), np.empty((size, 0)), np.empty(0))
    r = _triangle(fit, model, size)
    squares, vectors = right_vectors(r, min(components, size))
    model.values = squares / n
    used = vectors.shape[1]
    model.directions = vectors / np.sqrt(model.values[:used])
    trace = float((r * r).sum()) / n
    model.explained = model.values / trace if trace else np.zeros(len(model.values))
    model.identity_error = _identity_error(fit, model)
    return model


_SCHEMA = "long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, vector: str = "embedding", keep: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``table`` and component: ``keep``, component, n, deviation, whitened, explained, identity_error."""
    rows, schema = grid_rows(table, vector, keep), f"`{keep}` {_SCHEMA}"
    commonest = rows.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    if commonest is None or not commonest.bytes:
        return table.sparkSession.createDataFrame([], schema)
    size = commonest.bytes // 8
    model = table.sparkSession.sparkContext.broadcast(fit_model(rows, size, components))

    def project(batches):
        fitted = model.value
        k, used = len(fitted.values), fitted.directions.shape[1]
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            alike = np.flatnonzero(np.asarray(pc.binary_length(column)) == 8 * size)
            m = len(column)
            deviation: list = [None] * m
            whitened, known = np.zeros((m, k)), np.zeros((m, k), bool)
            if len(alike):
                centred = fitted.centred(_stacked(column.take(pa.array(alike))))
                whitened[alike, :used] = fitted.whitened(centred)
                known[np.ix_(alike, range(used))] = True
                for i, total in zip(alike.tolist(), squared_lengths(centred)):
                    deviation[i] = total if total < 2**63 else None
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, fitted.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(whitened.ravel(), mask=~known.ravel()),
                    pa.array(np.tile(fitted.explained, m)), pa.array(np.full(m * k, fitted.identity_error)),
                ],
                [keep, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
