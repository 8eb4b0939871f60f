"""The perceptron of spark.ml for many rows: equal rows are counted first, tasks then sum the loss and its slope over the counted rows.

spark.ml reads every row in every step and knows no row weights. Days and categories take few values, so there are far fewer different
rows than rows; where there are not, the steps still run in tasks, in blocks of rows. The loss (mean cross entropy of all rows), the first weights,
the layers and the rules for stopping are those of spark.ml, and so is the model. Its path is not: sums are made in another order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which spark.ml reads each row in each step.
PLAIN_ROWS = 200_000
# Different rows that one task sums in a step.
TASK_ROWS = 50_000
# Steps whose change of slope is remembered, and steps over which the loss has to fall.
REMEMBERED, RECENT = 10, 20

Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


def loss_and_slope(weights: np.ndarray, layers: Sequence[int], x: np.ndarray, label: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed cross entropy of a sigmoid network under a softmax, and its slope; weights lie as in spark.ml."""
    parts, at = [], 0
    for inputs, outputs in pairwise(layers):
        end = at + inputs * outputs
        parts.append((weights[at:end].reshape(inputs, outputs), weights[end:end + outputs]))
        at = end + outputs
    outs, rows = [x], np.arange(len(x))
    with np.errstate(over="ignore"):
        for w, b in parts[:-1]:
            outs.append(1 / (1 + np.exp(-(outs[-1] @ w + b))))
    top = outs[-1] @ parts[-1][0] + parts[-1][1]
    top -= top.max(axis=1, keepdims=True)
    total = np.exp(top).sum(axis=1)
    loss = float(np.dot(count, np.log(total) - top[rows, label]))
    error = np.exp(top) / total[:, None]
    error[rows, label] -= 1
    error *= count[:, None]
    slopes = []
    for place in range(len(parts) - 1, -1, -1):
        slopes = [(outs[place].T @ error).ravel(), error.sum(axis=0), *slopes]
        if place:
            error = (error @ parts[place][0].T) * outs[place] * (1 - outs[place])
    return loss, np.concatenate(slopes)


def counted(rows: DataFrame) -> DataFrame:
    """Different rows (x, label) with their number, some thousands to a row; held until the caller lets go of them."""
    def pack(frames):
        for frame in frames:
            yield pd.DataFrame([(len(frame), np.stack(frame.x.to_numpy()).astype(np.float64).tobytes(), frame.label.to_numpy(np.int64).tobytes(),
                                 frame["count"].to_numpy(np.float64).tobytes())], columns=["rows", "x", "label", "count"])
    found = rows.groupBy("x", "label").count().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # As few tasks as the different rows need, since every step starts them anew.
        each = found.repartition(max(1, -(-found.count() // TASK_ROWS)), "x", "label").sortWithinPartitions("x", "label")
        packs = each.mapInPandas(pack, "rows int, x binary, label binary, count binary").persist(StorageLevel.MEMORY_AND_DISK)
        packs.count()
    finally:
        found.unpersist()
    return packs


def mean_loss(packs: DataFrame, layers: Sequence[int], rows: int) -> Loss:
    """The mean loss of all rows as a function of the weights; a task sends one sum."""
    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def sums(frames):
            loss, slope = 0.0, np.zeros(len(weights))
            for frame in frames:
                for r in frame.itertuples(index=False):
                    x, label, count = np.frombuffer(r[1]).reshape(r[0], -1), np.frombuffer(r[2], np.int64), np.frombuffer(r[3])
                    own = loss_and_slope(weights, layers, x, label, count)
                    loss, slope = loss + own[0], slope + own[1]
            yield pd.DataFrame([(loss, slope.tobytes())], columns=["loss", "slope"])
        found = packs.mapInPandas(sums, "loss double, slope binary").collect()
        return sum(r.loss for r in found) / rows, sum(np.frombuffer(r.slope) for r in found) / rows
    return at


def least(f: Loss, x: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Where a function is least, by L-BFGS."""
    value, slope = f(x)
    first, seen, known = abs(value), [value], []
    for _ in range(steps):
        if np.linalg.norm(slope) <= max(tol * abs(value), 1e-8):
            break
        found = _searched(f, x, value, slope, _direction(slope, known), 1.0 if known else 1 / np.linalg.norm(slope))
        if found is None and known:
            known = []
            found = _searched(f, x, value, slope, -slope, 1 / np.linalg.norm(slope))
        if found is None:
            break
        moved, bent = found[0] - x, found[2] - slope
        if moved @ bent > 0:
            known = [*known, (moved, bent)][-REMEMBERED:]
        x, value, slope = found
        seen = [*seen, value][-RECENT:]
        if len(seen) == RECENT and abs(value - max(seen)) <= tol * first:
            break
    return x


def _direction(slope: np.ndarray, known: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out, shares = slope.copy(), []
    for moved, bent in reversed(known):
        shares.append((moved @ out) / (moved @ bent))
        out -= shares[-1] * bent
    if known:
        moved, bent = known[-1]
        out *= (moved @ bent) / (bent @ bent)
    for (moved, bent), share in zip(known, reversed(shares), strict=True):
        out += (share - (bent @ out) / (moved @ bent)) * moved
    return -out


def _searched(f: Loss, x: np.ndarray, value: float, slope: np.ndarray, way: np.ndarray, size: float, tries: int = 10):
    """A place along ``way`` that falls enough and is flat enough (the strong conditions of Wolfe); None if none is found."""
    def at(t):
        there = x + t * way
        new, own = f(there)
        return t, new, own @ way, (there, new, own)
    fall = slope @ way
    low, high = (0.0, value, fall, None), None
    for number in range(tries):
        c = at(size)
        if not c[1] <= value + 1e-4 * size * fall or (number and c[1] >= low[1]):
            high = c
            break
        if abs(c[2]) <= 0.9 * abs(fall):
            return c[3]
        if c[2] >= 0:
            low, high = c, low
            break
        low, size = c, size * 1.5
    for _ in range(tries if high else 0):
        c = at(_between(*sorted((low, high), key=lambda p: p[0])))
        if not c[1] <= value + 1e-4 * c[0] * fall or c[1] >= low[1]:
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(fall):
            return c[3]
        low, high = c, (low if c[2] * (high[0] - low[0]) >= 0 else high)
    return None


def _between(left: tuple, right: tuple) -> float:
    """Where the cubic through two places and their slopes is least, not too near either."""
    (l, left_value, left_slope, _), (r, right_value, right_slope, _) = left, right
    d1 = left_slope + right_slope - 3 * (left_value - right_value) / (l - r)
    d2 = np.sqrt(max(d1 * d1 - left_slope * right_slope, 0.0))
    under = right_slope - left_slope + 2 * d2
    t = r - (r - l) * (right_slope + d2 - d1) / under if under else (l + r) / 2
    t = t if np.isfinite(t) else (l + r) / 2
    return float(np.clip(t, l + 0.1 * (r - l), l + 0.9 * (r - l)))


class Perceptron(MultilayerPerceptronClassifier):
    """The perceptron of spark.ml where its rows are few, else fitted as above with the same parameters; gives the model of spark.ml."""

    def _fit(self, dataset):
        rows = dataset.count()
        if rows <= PLAIN_ROWS or self.getSolver() != "l-bfgs":
            return super()._fit(dataset)
        ready = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"))
        packs, one = counted(ready), dataset.limit(1)
        try:
            # Without steps spark.ml gives back the weights it begins with.
            begin = MultilayerPerceptronClassifier._fit(self.copy({self.maxIter: 0}), one).weights.toArray()
            weights = least(mean_loss(packs, self.getLayers(), rows), begin, self.getMaxIter(), self.getTol())
        finally:
            packs.unpersist()
        return MultilayerPerceptronClassifier._fit(self.copy({self.maxIter: 0, self.initialWeights: weights.tolist()}), one)
