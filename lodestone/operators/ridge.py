"""Ridge regression on mapped cross-sectional ranks: moments are summed by tasks, one small system is solved for all penalties.

The moments of the quadratic map hold those of the linear one, so one pass over the rows serves both maps and every penalty. A
task sends its upper triangle of sums by row of the matrix, which Spark adds up; as many numbers as the square of the map's columns
come to the driver, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mapped(ranks: np.ndarray) -> np.ndarray:
    """The quadratic map of ranks (rows x k): centred ranks, their squares, their distinct products; the first k columns are the linear map."""
    x = ranks - 0.5
    i, j = np.triu_indices(x.shape[1], 1)
    return np.hstack([x, x * x, x[:, i] * x[:, j]])


def moments(df: DataFrame, ranks: list[str], target: str) -> np.ndarray:
    """Sums of products of (1, mapped ranks, target) over all rows without nulls."""
    size = 2 + 2 * len(ranks) + len(ranks) * (len(ranks) - 1) // 2

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for f in frames:
            for at in range(0, len(f), 5000):
                part = f.iloc[at : at + 5000]
                z = np.hstack([np.ones((len(part), 1)), mapped(part[ranks].to_numpy()), part[[target]].to_numpy()])
                total += z.T @ z
        yield pd.DataFrame({"i": np.arange(size), "sums": [row[i:] for i, row in enumerate(total)]})

    rows = df.select(*[F.col(c).cast("double") for c in (*ranks, target)]).dropna()
    sums = rows.mapInPandas(partial, "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "v"))
    out = np.zeros((size, size))
    for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["i"] + r["j"]] = out[r["i"] + r["j"], r["i"]] = r["v"]
    return out


@dataclass
class Ridge:
    """Coefficients over the first columns of the map, for one penalty."""

    name: str
    penalty: float
    intercept: float
    weights: np.ndarray


def solve(moment: np.ndarray, ranks: int, penalties: tuple[float, ...]) -> list[Ridge]:
    """Models of both maps: minimise mean squared error + penalty * |b|^2 over columns standardised on these rows; the intercept has no penalty.

    A column that doesn't vary has weight 0. Without rows there are no models.
    """
    n = moment[0, 0]
    if not n:
        return []
    mean = moment[0] / n
    cov = moment / n - np.outer(mean, mean)
    models = []
    for name, columns in (("LINEAR", ranks), ("QUADRATIC", len(moment) - 2)):
        own = slice(1, 1 + columns)
        spread = np.sqrt(np.maximum(np.diag(cov)[own], 0))
        scale = np.where(spread > 1e-12, spread, np.inf)
        values, axes = np.linalg.eigh(cov[own, own] / np.outer(scale, scale))
        along = axes.T @ (cov[own, -1] / scale)
        for penalty in penalties:
            weights = axes @ (along / (np.maximum(values, 0) + penalty)) / scale
            models.append(Ridge(name, penalty, float(mean[-1] - mean[own] @ weights), weights))
    return models


def predict(df: DataFrame, ranks: list[str], keys: list[str], models: list[Ridge]) -> DataFrame:
    """keys, model (its place in the list) and prediction, for rows without null ranks."""
    width = max((len(m.weights) for m in models), default=0)
    table = np.array([np.pad(m.weights, (0, width - len(m.weights))) for m in models]).reshape(len(models), width)
    intercept = np.array([m.intercept for m in models])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 5000):
                part = f.iloc[at : at + 5000]
                values = mapped(part[ranks].to_numpy(dtype=float))[:, :width] @ table.T + intercept
                out = part[keys].copy()
                out["prediction"] = list(values)
                yield out

    plain = df.dropna(subset=ranks).select(*keys, *ranks)
    types = ", ".join(f"`{k}` {plain.schema[k].dataType.simpleString()}" for k in keys)
    return plain.mapInPandas(run, f"{types}, prediction array<double>").select(*keys, F.posexplode("prediction").alias("model", "prediction"))
