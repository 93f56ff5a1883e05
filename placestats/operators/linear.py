"""Least squares with several regressors, one fit per group, in column expressions.

A group's rows enter only through the sums of products of its regressors (`moments`),
which combine map-side. The normal equations are solved by a Cholesky factor built row by
row with `aggregate`, so a fit stays a column and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIDGE = 1e-8  # of the diagonal; keeps the equations of collinear regressors solvable


def moments(df: DataFrame, keys: Sequence[str], regressors: Sequence[Column], target: Column, *more: Column) -> DataFrame:
    """Per group: `xx` (matrix), `xy` (vector), `yy` and the number of rows `rows`, besides aggregates `more`."""
    k = len(regressors)
    sums = [F.sum(regressors[i] * regressors[j]).alias(f"_x{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(x * target).alias(f"_y{i}") for i, x in enumerate(regressors)]
    sums += [F.sum(target * target).alias("yy"), F.count(F.lit(1)).alias("rows"), *more]
    matrix = F.array(*[F.array(*[F.col(f"_x{min(i, j)}_{max(i, j)}") for j in range(k)]) for i in range(k)])
    out = df.groupBy(*keys).agg(*sums)
    drop = [c for c in out.columns if c.startswith("_x") or c.startswith("_y")]
    return out.withColumns({"xx": matrix, "xy": F.array(*[F.col(f"_y{i}") for i in range(k)])}).drop(*drop)


def pick(matrix: Column, index: Column) -> Column:
    """The square part of a matrix at the given positions."""
    return F.transform(index, lambda i: F.transform(index, lambda j: F.get(F.get(matrix, i), j)))


def pick_vector(vector: Column, index: Column) -> Column:
    return F.transform(index, lambda i: F.get(vector, i))


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays of one length, 0 for empty ones."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _places(a: Column) -> Column:
    return F.transform(a, lambda _, i: i)


def cholesky(matrix: Column, ridge: float = RIDGE) -> Column:
    """Rows of the lower factor, the i-th with i + 1 numbers; the diagonal is raised by `ridge` of itself."""

    def row(rows: Column, i: Column) -> Column:
        left = F.get(matrix, i)

        def number(done: Column, j: Column) -> Column:
            other = F.get(rows, j)
            return F.array_append(done, (F.get(left, j) - dot(done, F.slice(other, 1, j))) / F.get(other, j))

        before = F.aggregate(F.slice(_places(matrix), 1, i), F.array().cast("array<double>"), number)
        return F.transform(
            F.array(before), lambda b: F.array_append(b, F.sqrt(F.greatest(F.get(left, i) * (1 + ridge) - dot(b, b), F.get(left, i) * ridge, F.lit(1e-12))))
        )[0]

    return F.aggregate(_places(matrix), F.array().cast("array<array<double>>"), lambda rows, i: F.array_append(rows, row(rows, i)))


def solve(factor: Column, right: Column) -> Column:
    """The x with (L L') x = right for a factor of `cholesky`."""

    def down(done: Column, i: Column) -> Column:
        left = F.get(factor, i)
        return F.array_append(done, (F.get(right, i) - dot(done, F.slice(left, 1, i))) / F.get(left, i))

    half = F.aggregate(_places(factor), F.array().cast("array<double>"), down)

    def up(z: Column) -> Column:
        def number(done: Column, i: Column) -> Column:
            below = F.transform(done, lambda x, k: x * F.get(F.get(factor, (i + 1 + k).cast("int")), i))
            rest = F.aggregate(below, F.lit(0.0), lambda s, x: s + x)
            return F.array_prepend(done, (F.get(z, i) - rest) / F.get(F.get(factor, i), i))

        return F.aggregate(F.reverse(_places(factor)), F.array().cast("array<double>"), number)

    return F.transform(F.array(half), up)[0]


def residual(yy: Column, beta: Column, xy: Column) -> Column:
    """Sum of squared residuals of a fit, never below 0."""
    return F.greatest(yy - dot(beta, xy), F.lit(0.0))
