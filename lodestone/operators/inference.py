"""Circular block bootstrap of short ordered series, one for each definition."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def block_bootstrap(series: DataFrame, keys: list[str], order: str, net: str, block: int, replications: int, seed: int) -> DataFrame:
    """keys, low and high (95 % interval of the mean) and p (one-sided, of the centred series); a series has one value a session."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[net].dropna().to_numpy()
        out = {k: [pdf[k].iloc[0]] for k in keys}
        if not len(x):
            return pd.DataFrame({**out, "low": [None], "high": [None], "p": [None]})
        rng, means = np.random.Generator(np.random.PCG64(seed)), np.empty(replications)
        for i in range(0, replications, 2000):
            n = min(2000, replications - i)
            draws = rng.integers(0, len(x), size=(n, -(-len(x) // block)))
            means[i : i + n] = x[(draws[:, :, None] + np.arange(block)).reshape(n, -1)[:, : len(x)] % len(x)].mean(axis=1)
        low, high = np.quantile(means, [0.025, 0.975])
        p = (1 + int((means - x.mean() >= x.mean()).sum())) / (replications + 1)
        return pd.DataFrame({**out, "low": [round(float(low), 9)], "high": [round(float(high), 9)], "p": [p]})

    types = ", ".join(f"`{k}` {series.schema[k].dataType.simpleString()}" for k in keys)
    return series.groupBy(*keys).applyInPandas(run, f"{types}, low double, high double, p double")
