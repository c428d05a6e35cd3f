"""Principal components of array columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from millrace.operators.moments import whole_rows
from millrace.session import stage

#: vectors of up to so many places have their covariance on the driver; wider ones are iterated on
HELD_PLACES = 2048
#: directions that an iteration carries besides the wanted ones
SPARE = 8
ROUNDS = 500
#: an iteration ends when the directions are off by less than this, relative to the first eigenvalue
TOLERANCE = 1e-9
#: products that meet in one task or on the driver
MEETING = 16


@dataclass(frozen=True)
class Components:
    """`directions` is d x k, each column signed so that its largest entry is positive;
    `eigenvalues` are the largest ones, all d where the covariance was held, for the covariance
    divided by n; `total` is the sum of all d."""

    directions: np.ndarray
    eigenvalues: np.ndarray
    total: float

    def variance_explained(self, k: int) -> float:
        if k > len(self.eigenvalues):
            raise ValueError(f"{len(self.eigenvalues)} eigenvalues are known")
        return float(self.eigenvalues[:k].sum() / self.total) if self.total else float("nan")


def fit_components(df: DataFrame, k: int, features: str = "features", held: int = HELD_PLACES) -> Components:
    """The `k` leading components. Rows with a NULL array or element are left out. Up to `held` places
    the covariance and its decomposition are the library's; wider vectors go through
    `iterate_components`, which holds nothing of d x d."""
    rows = whole_rows(df, features).select(array_to_vector(F.col(features)).alias("_v"))
    summary = Summarizer.metrics("mean", "variance", "count").summary(F.col("_v"))
    found = rows.agg(summary.alias("s")).select("s.mean", "s.variance", "s.count").first()
    if not found["count"]:
        raise ValueError("no rows to fit")
    n = found["count"]
    total = float(found["variance"].toArray().sum()) * (n - 1) / n
    means = found["mean"].toArray()
    if len(means) > held:
        directions, eigenvalues = iterate_components(rows.select(vector_to_array("_v").alias("_z")), means, n, k)
    else:
        model = PCA(k=len(means), inputCol="_v", outputCol="_s").fit(rows)
        directions, eigenvalues = model.pc.toArray()[:, :k], np.asarray(model.explainedVariance.toArray()) * total
    return Components(_signed(directions), eigenvalues, total)


def _signed(directions: np.ndarray) -> np.ndarray:
    peaks = directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])]
    return directions * np.where(peaks < 0, -1.0, 1.0)


def iterate_components(rows: DataFrame, means: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal iteration on the covariance of `rows` (_z, arrays without NULLs): (directions,
    eigenvalues), the `k` largest.

    A round multiplies the covariance with k + SPARE orthogonal vectors: a task multiplies its rows'
    batches with them and back, and sends d x (k + SPARE) numbers, which are added in levels. The
    driver holds as many. The values and directions are read off the vectors' span (Rayleigh
    and Ritz), and the rounds end when these are within TOLERANCE, at the latest after ROUNDS.
    """
    width, size = len(means), min(len(means), k + SPARE)
    stored = stage(rows, "component-rows")
    basis = np.linalg.qr(np.random.default_rng(7).normal(size=(width, size)))[0]
    for _ in range(ROUNDS):
        product = _multiplied(stored, means, basis) / n
        values, inner = np.linalg.eigh(basis.T @ product)
        values, inner = values[::-1], inner[:, ::-1]
        ritz = basis @ inner
        off = np.linalg.norm((product @ inner)[:, :k] - ritz[:, :k] * values[:k], axis=0)
        if off.max() <= TOLERANCE * max(abs(values[0]), np.finfo(float).tiny):
            break
        basis = np.linalg.qr(product)[0]
    return ritz[:, :k], values[:k]


def _multiplied(rows: DataFrame, means: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum over rows of (z - mean) (z - mean)' basis."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((means, basis))

    def multiply(batches):
        means, basis = shared.value
        total = np.zeros(basis.shape)
        for batch in batches:
            if batch.num_rows:
                z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(means)) - means
                total += z.T @ (z @ basis)
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    sent = rows.mapInArrow(multiply, "part binary")
    tasks = rows.rdd.getNumPartitions()
    while tasks > MEETING:
        tasks = -(-tasks // MEETING)
        sent = sent.repartition(tasks).mapInArrow(_add_up, "part binary")
    total = np.zeros(basis.shape)
    for r in sent.collect():
        total += np.frombuffer(r["part"]).reshape(basis.shape)
    shared.destroy()
    return total


def _add_up(batches):
    total = None
    for batch in batches:
        for raw in batch.column("part").to_pylist():
            total = np.frombuffer(raw) + (0.0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})


def with_scores(df: DataFrame, components: Components, features: str = "features") -> DataFrame:
    """Add `scores`: the row, not centred, times each direction; NULL for a row with a NULL array or
    element. The directions are sent to the tasks once."""
    shared = df.sparkSession.sparkContext.broadcast(components.directions)
    place = df.columns.index(features)

    def score(batches):
        directions = shared.value
        width, k = directions.shape
        for batch in batches:
            vectors = batch.column(place)
            holes = pc.list_parent_indices(vectors).filter(pc.is_null(pc.list_flatten(vectors)))
            bad = np.zeros(batch.num_rows, dtype=bool)
            bad[holes.to_numpy(zero_copy_only=False)] = True
            bad |= vectors.is_null().to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(vectors.filter(pa.array(~bad))).to_numpy(zero_copy_only=False).astype(float)
            scores = flat.reshape(-1, width) @ directions
            lengths = np.where(bad, 0, k)
            out = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(scores.ravel()), mask=pa.array(bad))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "scores"])

    schema = StructType([*df.schema.fields, StructField("scores", ArrayType(DoubleType()))])
    return df.mapInArrow(score, schema)
