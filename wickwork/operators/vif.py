"""Variance inflation factors from one distributed Gram matrix, in one pass.

Every method needs only the columns' means and products. Tasks merge them over Arrow batches, each centred at its own
mean, so nothing is lost to large means; a few more tasks merge what tasks found, and the driver gets those few matrices.
"""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMERIC = ("double", "float", "bigint", "int")
METHODS = ("matrix", "parallel", "streaming")
SINGULAR = 1e-10


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC]


def _merged(a: tuple | None, n: int, mean: np.ndarray, m2: np.ndarray) -> tuple:
    """Two sets of rows as one: (rows, means, sums of products of centred columns)."""
    if a is None or not a[0]:
        return n, mean, m2
    if not n:
        return a
    d, total = mean - a[1], a[0] + n
    return total, a[1] + d * (n / total), a[2] + m2 + np.outer(d, d) * (a[0] * n / total)


def moments(df: DataFrame, columns: list[str], chunk: int = 10_000) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(rows without missing values, rows with, means, Gram matrix of centred columns)."""
    k, parts = len(columns), 8
    schema = "part int, n long, bad long, mean array<double>, m2 array<double>"

    def row(part: int, bad: int, a: tuple | None) -> pa.RecordBatch:
        n, mean, m2 = a if a is not None else (0, np.zeros(k), np.zeros((k, k)))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, n, bad, mean, m2.ravel()), kinds, strict=True)], ["part", "n", "bad", "mean", "m2"])

    def over_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, bad = None, 0
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.slice(at, chunk).columns]).astype(float)
                whole = ~np.isnan(x).any(axis=1)
                bad += int((~whole).sum())
                x = x[whole]
                if len(x):
                    mean = x.mean(axis=0)
                    total = _merged(total, len(x), mean, (x - mean).T @ (x - mean))
        yield row(TaskContext.get().partitionId() % parts, bad, total)

    def over_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bad = None, 0
        for b in batches:
            for _, n, more, mean, m2 in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total, bad = _merged(total, n, np.array(mean), np.array(m2).reshape(k, k)), bad + more
        yield row(0, bad, total)

    d = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    total, bad = None, 0
    for r in d.mapInArrow(over_rows, schema).repartition(parts, "part").mapInArrow(over_parts, schema).collect():
        total, bad = _merged(total, r["n"], np.array(r["mean"]), np.array(r["m2"]).reshape(k, k)), bad + r["bad"]
    return (total[0], bad, *total[1:]) if total else (0, bad, np.zeros(k), np.zeros((k, k)))


def factors(g: np.ndarray, method: str, means: np.ndarray | None = None, n: int = 1, jobs: int = 1) -> np.ndarray:
    """VIF by column from the Gram matrix of centred columns."""
    d = np.diag(g).copy()
    scale = np.abs(means) ** 2 * n if means is not None else np.zeros(len(d))
    constant = d <= 1e-24 * np.maximum(scale, 1e-300)
    unit = np.where(constant, 1.0, np.sqrt(np.maximum(d, 1e-300)))
    r = np.where(constant[:, None] | constant[None, :], 0.0, g / unit[:, None] / unit[None, :])
    if method == "streaming":
        try:
            inverse = np.linalg.inv(r)
        except np.linalg.LinAlgError:
            inverse = np.linalg.pinv(r)
        return np.maximum(np.diag(inverse), 1.0)
    if method == "matrix":
        if constant.any() or (np.abs(np.linalg.eigvalsh(r)) < SINGULAR).any():
            return np.full(len(d), np.inf)
        return np.maximum(np.diag(np.linalg.inv(r)), 1.0)
    out = np.full(len(d), np.inf)

    def one(i: int) -> None:
        rest = np.flatnonzero(np.arange(len(d)) != i)
        beta = np.linalg.lstsq(r[np.ix_(rest, rest)], r[rest, i], rcond=None)[0]
        left = 1 - r[rest, i] @ beta
        out[i] = 1 / left if left > 1e-14 else np.inf

    with ThreadPoolExecutor(jobs) as pool:
        list(pool.map(one, np.flatnonzero(~constant)))
    return out


def vif(df: DataFrame, method: str = "matrix", threshold: float | None = None, drop_na: bool = True, n_jobs: int = -1, chunk_size: int = 10_000) -> DataFrame:
    """(feature, VIF), of at least threshold where given.

    Columns of type double, float, bigint and int are features; others are left out with a warning. Spark's tasks are the workers, so
    n_jobs bounds only the threads on the driver that solve the regressions of method parallel (-1: all cores); chunk_size is the number of rows
    that a task holds as a matrix at once, whatever the size of Arrow batches.

    matrix: inverse of the correlations; if they are singular all are infinite. parallel: a regression for each column; a constant
    or fully explained column is infinite, the others are not. streaming: inverse or pseudo-inverse, never infinite.
    Rows with null or NaN are left out, or refused with drop_na=False.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {', '.join(METHODS)}")
    if chunk_size < 1 or n_jobs == 0:
        raise ValueError("chunk_size is at least 1, and n_jobs is not 0")
    columns = numeric_columns(df)
    if skipped := [c for c in df.columns if c not in columns]:
        warnings.warn(f"not numeric, left out: {', '.join(skipped)}", stacklevel=2)
    if len(columns) < 2:
        raise ValueError("at least 2 features are needed")
    n, bad, means, gram = moments(df, columns, chunk_size)
    if bad and not drop_na:
        raise ValueError(f"{bad} rows have missing values")
    if n < 2:
        raise ValueError("at least 2 rows are needed")
    found = factors(gram, method, means, n, n_jobs if n_jobs > 0 else os.cpu_count() or 1)
    out = df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, found, strict=True)], "feature string, VIF double")
    return out.where(F.col("VIF") >= threshold) if threshold is not None else out
