"""Ordinary least squares for several targets at once, on inputs that may be collinear.

A first pass over the training rows finds means and spreads, a second one sums the Gramian of the
standardised inputs and their products with all targets; each task adds up its own rows, so what is
shuffled does not grow with them. The small system is solved on the driver by its eigenvalues: directions
without spread take no part, and of all solutions the one with the smallest coefficients (in
the inputs' own units) is taken, which is what a least-squares solver gives for a singular matrix.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from shelfcast.functions.numeric import fill_missing
from shelfcast.sources.staging import stage

# Directions whose share of the largest spread is below this (as a variance) count as none.
TOLERANCE = 1e-10


@dataclass(frozen=True)
class LinearModel:
    """Coefficients per label (labels x columns) and intercepts."""

    columns: tuple
    labels: tuple
    coefficients: np.ndarray
    intercepts: np.ndarray

    def predict(self, rows, fill, suffix=""):
        """The rows with one forecast column per label; missing inputs take the fill value."""
        inputs = [f"coalesce(cast({c} AS double), {float(fill)!r}D)" for c in self.columns]
        weights = np.column_stack([self.coefficients, self.intercepts])
        sums = []
        for label, row in zip(self.labels, weights.tolist()):
            terms = ", ".join(f"{w!r}D" for w in row)
            # One array of inputs serves all labels; a lambda keeps the generated code small.
            sums.append(
                "aggregate(zip_with(inputs__, array("
                f"{terms}), (x, w) -> x * w), 0D, (a, x) -> a + x) AS {label}{suffix}"
            )
        wide = rows.selectExpr("*", f"array({', '.join([*inputs, '1D'])}) AS inputs__")
        return wide.selectExpr(*rows.columns, *sums)


def _moments(rows, columns):
    """Number of rows, and mean and standard deviation of each column, as numpy arrays."""
    parts = [F.count(F.lit(1))]
    parts += [f(c).cast("double") for c in columns for f in (F.avg, F.stddev_pop)]
    found = rows.agg(*[p.alias(f"m{k}") for k, p in enumerate(parts)]).first()
    values = np.array([0.0 if v is None else v for v in found[1:]]).reshape(-1, 2)
    return found[0], values[:, 0], values[:, 1]


def _products(rows, columns, means, spreads):
    """Sums over all rows of z z' for the standardised columns z, as one matrix.

    A task gives one row per column with the sums of its rows; these are added up by column.
    """
    size = len(columns)
    schema = pa.schema([("row", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            z = (z - means) / spreads
            total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(total.tolist(), schema.field(1).type)],
            schema=schema,
        )

    partial = rows.select(*columns).mapInArrow(run, "row int, sums array<double>")
    summed = partial.groupBy("row").agg(
        Summarizer.sum(array_to_vector("sums")).alias("sums")
    )
    matrix = np.zeros((size, size))
    for found in summed.collect():  # one row per column
        matrix[found["row"]] = found["sums"].toArray()
    return matrix


def minimum_norm(gram, right, spreads, tolerance=TOLERANCE):
    """Smallest coefficients in the columns' own units that solve the standardised system.

    gram: Gramian of standardised columns; right: products with the targets (columns x targets).
    """
    values, vectors = np.linalg.eigh(gram)
    kept = values > tolerance * max(values.max(initial=0.0), np.finfo(float).tiny)
    basis = vectors[:, kept]
    solution = (basis @ ((basis.T @ right) / values[kept][:, None])) / spreads[:, None]
    # Moving along a direction without spread changes no forecast; take off what lies in them.
    null = vectors[:, ~kept]
    if null.shape[1]:
        orthogonal, _ = np.linalg.qr(_in_own_units(null, spreads))
        solution -= orthogonal @ (orthogonal.T @ solution)
    return solution


def _in_own_units(null, spreads):
    """A basis of the directions without spread, from one of the standardised columns.

    Every direction has its own column, of small spread where possible, in which no other one moves: what
    rounding leaves of the others there would grow with the ratio of the spreads.
    """
    chosen, rest = [], null.copy()
    for k in np.argsort(spreads, kind="stable"):
        size = np.linalg.norm(rest[k])
        if size > 1e-6 and len(chosen) < null.shape[1]:
            chosen.append(k)
            unit = rest[k] / size
            rest -= np.outer(rest @ unit, unit)
    if len(chosen) < null.shape[1]:
        return null / spreads[:, None]
    null = null @ np.linalg.inv(null[chosen])
    null[chosen] = np.eye(len(chosen))
    return null * spreads[chosen] / spreads[:, None]


def fit_linear(train, columns, labels, fill):
    """Least squares of every label on the columns, with intercepts.

    Missing inputs take the fill value and rows without a label are left out for all labels. A
    constant column has the coefficient 0, an empty table gives zeros throughout.
    """
    columns, labels = tuple(columns), tuple(labels)
    used = fill_missing(train.select(*labels, *columns), fill, columns)
    used = used.selectExpr(*columns, *[f"cast({w} AS double) AS {w}" for w in labels])
    used = stage(used.dropna(subset=list(labels)), "linear")
    n, means, spreads = _moments(used, [*columns, *labels])
    size = len(columns)
    coefficients = np.zeros((len(labels), size))
    moving = spreads > 1e-12 * np.maximum(np.abs(means), 1e-300)
    inputs = np.flatnonzero(moving[:size])
    if n and len(inputs):
        scale = np.where(moving, spreads, 1.0)
        matrix = _products(used, [*columns, *labels], means, scale)
        gram = matrix[np.ix_(inputs, inputs)]
        right = matrix[inputs, size:] * scale[size:]
        coefficients[:, inputs] = minimum_norm(gram, right, scale[inputs]).T
    intercepts = means[size:] - coefficients @ means[:size]
    return LinearModel(columns, labels, coefficients, intercepts)
