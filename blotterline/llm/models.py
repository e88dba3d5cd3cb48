"""Small models, fitted on the driver or by sums over tasks, and characters as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LETTER, UPPER, DIGIT, SPACE, OTHER = range(5)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point: letter, upper-case letter, digit, white space or other."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            classes[code] = UPPER if c.isupper() else LETTER
        elif c.isspace():
            classes[code] = SPACE
        elif c.isdigit():
            classes[code] = DIGIT
    return classes


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points one after another, and the number of each."""
    body = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(body, np.uint32), np.array([len(t) for t in texts], np.int64)


def sums_by_text(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text's stretch; empty texts: 0."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    stops = np.cumsum(lengths)
    return running[stops] - running[stops - lengths]


def fit_logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50, sample_weights: np.ndarray | None = None
) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last one is the constant."""
    rows = np.ones(len(y)) if sample_weights is None else sample_weights
    x = np.column_stack([x, np.ones(len(x))])
    return _newton(lambda weights: _slopes(x, y, rows, weights), x.shape[1], ridge, rounds)


def _slopes(x: np.ndarray, y: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the rows' log loss."""
    p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
    return x.T @ (rows * (p - y)), (x * (rows * p * (1 - p))[:, None]).T @ x


def _newton(
    slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, ridge: float, rounds: int
) -> np.ndarray:
    penalty = np.diag([ridge] * (width - 1) + [1e-3])
    weights = np.zeros(width)
    for _ in range(rounds):
        gradient, hessian = slopes(weights)
        step = np.linalg.solve(hessian + penalty, gradient + penalty @ weights)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit_logistic_rows(
    rows: DataFrame, centre: np.ndarray, spread: np.ndarray, ridge: float = 1.0, rounds: int = 50
) -> np.ndarray:
    """As ``fit_logistic`` on all rows (x array<double>, y double) of a table, standardized by ``centre``
    and ``spread``: each task adds up its rows' slopes, each step is one job over the table."""
    width = len(centre) + 1

    def slopes(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((width + 1, width))
            for frame in frames:
                if len(frame):
                    x = (np.stack(frame["x"].to_list()) - centre) / spread
                    x = np.column_stack([x, np.ones(len(x))])
                    gradient, hessian = _slopes(x, frame["y"].to_numpy(float), np.ones(len(x)), weights)
                    total += np.vstack([gradient, hessian])
            yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

        sums = rows.select("x", "y").mapInPandas(run, "at int, value double")
        found = sums.groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
        total = np.array([row["value"] for row in found]).reshape(width + 1, width)
        return total[0], total[1:]

    return _newton(slopes, width, ridge, rounds)


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))


def bounded_sample(rows: DataFrame, per_class: int, by: str, key: str = "doc_id") -> DataFrame:
    """For each value of ``by`` at most ``per_class`` rows, those of the least hashes of ``key``.

    A repeated key counts once, so copies cannot crowd others out. Only ``by`` and ``key`` are
    sorted; Spark keeps ``per_class`` rows per value and task before it shuffles them.
    """
    ordered = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    keys = rows.select(by, key).distinct()
    chosen = keys.withColumn("_at", F.row_number().over(ordered)).where(F.col("_at") <= per_class)
    return chosen.drop("_at")
