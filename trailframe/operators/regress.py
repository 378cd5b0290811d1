"""Linear regression: one pass for the moments, a small solve, and the prediction as a column expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe.functions.columns import normal_quantile
from trailframe.operators.ordered import Ordered

LEARNING_RATE = 0.05
#: Largest relative change of a settled coefficient.
SETTLED = 1e-13
#: Ranks that one value gets at once.
RANK_BLOCK = 65_536


@dataclass(frozen=True)
class Fit:
    """``coefficients`` refer to the features after ``(x - shift) / scale``."""

    features: tuple[str, ...]
    target: str
    coefficients: tuple[float, ...]
    bias: float
    shift: tuple[float, ...]
    scale: tuple[float, ...]
    iterations: int = 0

    def scaled(self) -> list[Column]:
        return [(F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in zip(self.features, self.shift, self.scale)]

    def prediction(self) -> Column:
        total = F.lit(0.0)
        for x, c in zip(self.scaled(), self.coefficients):
            total = total + x * F.lit(c)
        return total + F.lit(self.bias)

    def residuals(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``residual``."""
        predicted = df.withColumn("prediction", self.prediction())
        return predicted.withColumn("residual", F.col(self.target) - F.col("prediction"))

    def mse(self, df: DataFrame) -> DataFrame:
        return self.residuals(df).agg(F.avg(F.col("residual") * F.col("residual")).alias("mse"))

    def table(self, spark) -> DataFrame:
        rows = [*zip(self.features, self.coefficients), ("bias", self.bias)]
        return spark.createDataFrame([(n, float(c)) for n, c in rows], "feature string, coefficient double")


def _scaling(df: DataFrame, features: Sequence[str], preprocess: bool, deviation) -> tuple[tuple, tuple]:
    if not preprocess:
        return (0.0,) * len(features), (1.0,) * len(features)
    row = df.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
                 *[deviation(f).alias(f"s{i}") for i, f in enumerate(features)]).first()
    return (tuple(float(row[f"m{i}"]) for i in range(len(features))),
            tuple(float(row[f"s{i}"]) or 1.0 for i in range(len(features))))


def _moments(df: DataFrame, features: Sequence[str], target: str, shift, scale):
    """X'X, X'y, mean of X, mean of y and the row count of the scaled features, in one aggregate."""
    x = [(F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in zip(features, shift, scale)]
    d, y = len(x), F.col(target)
    aggregates = [F.sum(x[i] * x[j]).alias(f"g{i}_{j}") for i in range(d) for j in range(i, d)]
    aggregates += [F.sum(x[i] * y).alias(f"h{i}") for i in range(d)] + [F.avg(x[i]).alias(f"m{i}") for i in range(d)]
    row = df.agg(*aggregates, F.avg(y).alias("y"), F.count(F.lit(1)).alias("n")).first()
    gram = np.array([[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)], dtype=float)
    return gram, np.array([row[f"h{i}"] for i in range(d)]), np.array([row[f"m{i}"] for i in range(d)]), row["y"], row["n"]


def fit_ols(df: DataFrame, features: Sequence[str], target: str, preprocess: bool = True) -> Fit:
    """Ordinary least squares with intercept, by the library's normal-equation solver."""
    shift, scale = _scaling(df, features, preprocess, F.stddev_pop)
    probe = Fit(tuple(features), target, (0.0,) * len(features), 0.0, shift, scale)
    scaled = df.select(*[c.alias(f"x{i}") for i, c in enumerate(probe.scaled())], F.col(target).cast("double").alias("y"))
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="v").transform(scaled)
    model = LinearRegression(featuresCol="v", labelCol="y", solver="normal", regParam=0.0, standardization=False).fit(vectors)
    return Fit(tuple(features), target, tuple(float(c) for c in model.coefficients), float(model.intercept), shift, scale)


def fit_exact(df: DataFrame, features: Sequence[str], target: str, preprocess: bool = True) -> Fit:
    """Normal equations without an intercept column; the bias is the mean residual.

    With ``preprocess`` the features are standardised by the sample deviation, which makes this ordinary least squares;
    without it, it is a fit through the origin plus the mean residual.
    """
    shift, scale = _scaling(df, features, preprocess, F.stddev_samp)
    gram, cross, means, y, _ = _moments(df, features, target, shift, scale)
    theta = np.linalg.solve(gram, cross)
    return Fit(tuple(features), target, tuple(map(float, theta)), float(y - theta @ means), shift, scale)


def fit_gradient(df: DataFrame, features: Sequence[str], target: str, preprocess: bool = True,
                 rate: float = LEARNING_RATE, seed: int = 42, max_iterations: int = 100_000) -> Fit:
    """Full-batch gradient descent on the mean squared error from a random start until the coefficients settle.

    The gradient needs only X'X and X'y, so the data is read once. It is a mean over rows, so a rate means the same on
    every table size. Raises ``RuntimeError`` when the iterations don't settle (a rate too small or too large).
    """
    shift, scale = _scaling(df, features, preprocess, F.stddev_samp)
    gram, cross, means, y, n = _moments(df, features, target, shift, scale)
    theta = np.random.default_rng(seed).random(len(features))
    for done in range(1, max_iterations + 1):
        moved = theta + 2.0 * rate * (cross - gram @ theta) / n
        change = float(np.abs(moved - theta).max())
        theta = moved
        if not change < 1e100:
            break
        if change <= SETTLED * max(1.0, float(np.abs(theta).max())):
            return Fit(tuple(features), target, tuple(map(float, theta)), float(y - theta @ means), shift, scale, done)
    raise RuntimeError(f"gradient descent did not settle at rate {rate} within {max_iterations} iterations")


def coefficient_importance(fit: Fit, spark) -> DataFrame:
    """(kind, number, feature, coefficient) of the extreme coefficients; numbers start at 1, the first of equal ones wins.

    The two positive kinds have no row when no coefficient is positive.
    """
    rows = [(i, f, float(c)) for i, (f, c) in enumerate(zip(fit.features, fit.coefficients), start=1)]
    table = spark.createDataFrame(rows, "number int, feature string, coefficient double")
    c, entry = F.col("coefficient"), F.struct("number", "feature", "coefficient")
    rank = lambda value: F.struct(value.alias("v"), F.col("number"))
    kinds = {
        "min_positive": F.when(c > 0, rank(c)), "max_positive": F.when(c > 0, rank(-c)),
        "min_absolute": rank(F.abs(c)), "max_absolute": rank(-F.abs(c)),
    }
    best = table.agg(*[F.min_by(entry, by).alias(kind) for kind, by in kinds.items()])
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("e")) for kind in kinds])
    return best.select(F.explode(entries).alias("x")).where("x.e IS NOT NULL").select("x.kind", "x.e.*")


def probability_points(df: DataFrame, name: str) -> DataFrame:
    """(rank, theoretical, ordered): normal probability plot with Filliben's order-statistic medians.

    Repeated values are counted first and get their range of ranks in blocks, so neither a frequent value nor the whole
    column is ordered in one task. Nulls have no rank.
    """
    counted = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_w"))
    ranked = Ordered.open(counted, [], [name], F.col(name)).running_sum({"_upto": F.col("_w")}).finish()
    total = ranked.agg(F.max("_upto").alias("_n"))
    start = F.explode(F.sequence(F.col("_upto") - F.col("_w") + 1, F.col("_upto"), F.lit(RANK_BLOCK).cast("long"))).alias("_from")
    blocks = ranked.select(name, "_upto", start).repartition(F.col("_from"))
    each = blocks.select(name, F.explode(F.sequence("_from", F.least(F.col("_upto"), F.col("_from") + RANK_BLOCK - 1))).alias("rank"))
    counted = each.join(F.broadcast(total), F.lit(True))
    n, i = F.col("_n"), F.col("rank")
    edge = F.pow(F.lit(0.5), 1.0 / n)
    median = F.when(i == n, edge).when(i == 1, 1.0 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return counted.select(F.col("rank").cast("long"), normal_quantile(median).alias("theoretical"), F.col(name).alias("ordered"))
