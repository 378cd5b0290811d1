"""Feature preparation: alignment, scaling, principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions.columns import epoch_seconds
from trailframe.operators.enrich import align
from trailframe.operators.regions import filter_positions
from trailframe.operators.segments import renumber_segments

VARIANCE_SHARE = 0.8


def prepare(merge: DataFrame, pos_gen: DataFrame | None = None, columns: Sequence[str] = S.HEURISTIC_COLS,
            renumber: bool = True) -> DataFrame:
    """Box-filter, bring heuristic columns to the merge rows, renumber segments, turn times into float seconds."""
    joined = filter_positions(merge)
    if pos_gen is not None:
        joined = align(joined, filter_positions(pos_gen), list(columns))
        if renumber and "timedelta_id" in columns:
            joined = renumber_segments(joined)
    times = ["start_time", "stop_time", "server_time", "device_time"]
    return joined.withColumns({t: epoch_seconds(F.col(t)) for t in times})


@dataclass(frozen=True)
class Moments:
    """Count, means, population covariances, minima and maxima of some columns, from one aggregate."""

    names: tuple[str, ...]
    n: int
    mean: np.ndarray
    cov: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, df: DataFrame, names: Sequence[str]) -> "Moments":
        d = len(names)
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        row = df.select(*[F.col(n).cast("double").alias(f"v{i}") for i, n in enumerate(names)]).agg(
            F.count(F.lit(1)).alias("n"), *[f(f"v{i}").alias(f"{k}{i}") for i in range(d)
                                            for k, f in (("m", F.avg), ("a", F.min), ("b", F.max))],
            *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        take = lambda k: np.array([row[f"{k}{i}"] if row[f"{k}{i}"] is not None else 0.0 for i in range(d)], dtype=float)
        cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(d)] for i in range(d)], dtype=float)
        return cls(tuple(names), int(row["n"]), take("m"), cov, take("a"), take("b"))

    @property
    def deviation(self) -> np.ndarray:
        """Population deviations; 1 for a constant column."""
        found = np.sqrt(np.maximum(np.diag(self.cov), 0.0))
        return np.where(self.high > self.low, np.where(found > 0, found, 1.0), 1.0)

    @property
    def span(self) -> np.ndarray:
        return np.where(self.high > self.low, self.high - self.low, 1.0)

    def moved(self, shift: np.ndarray, scale: np.ndarray, names: Sequence[str] | None = None) -> "Moments":
        """Moments of ``(x - shift) / scale``."""
        return Moments(tuple(names or self.names), self.n, (self.mean - shift) / scale, self.cov / np.outer(scale, scale),
                       (self.low - shift) / scale, (self.high - shift) / scale)

    def only(self, names: Sequence[str]) -> "Moments":
        at = [self.names.index(n) for n in names]
        return Moments(tuple(names), self.n, self.mean[at], self.cov[np.ix_(at, at)], self.low[at], self.high[at])


def _scaled(df: DataFrame, names: Sequence[str], shift: np.ndarray, scale: np.ndarray) -> DataFrame:
    return df.withColumns({n: (F.col(n) - F.lit(float(m))) / F.lit(float(s)) for n, m, s in zip(names, shift, scale)})


def standardize(df: DataFrame, names: Sequence[str], moments: Moments | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    m = moments or Moments.of(df, names)
    return _scaled(df, names, m.mean, m.deviation)


def min_max(df: DataFrame, names: Sequence[str], moments: Moments | None = None) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0."""
    m = moments or Moments.of(df, names)
    return _scaled(df, names, m.low, m.span)


def unit_norm(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Scale each row to Euclidean length 1; a zero row stays zero."""
    total = F.lit(0.0)
    for n in names:
        total = total + F.col(n) * F.col(n)
    length = F.sqrt(total)
    divisor = F.when(length == 0, F.lit(1.0)).otherwise(length)
    return df.withColumns({n: F.col(n) / divisor for n in names})


@dataclass(frozen=True)
class Components:
    """A fitted projection: ``loadings[i]`` are the weights of component i, largest weight positive."""

    names: tuple[str, ...]
    means: tuple[float, ...]
    loadings: tuple[tuple[float, ...], ...]
    variance: tuple[float, ...]

    def column(self, i: int) -> Column:
        total = F.lit(0.0)
        for n, m, w in zip(self.names, self.means, self.loadings[i]):
            total = total + (F.col(n) - F.lit(m)) * F.lit(w)
        return total


def fit_components(moments: Moments, k: int | None = None) -> Components:
    """Principal components from the covariances; applying them is a plain column expression."""
    values, vectors = np.linalg.eigh(moments.cov)
    order = np.argsort(-values, kind="stable")[:len(moments.names) if k is None else k]
    loadings = vectors[:, order].T
    loadings = np.array([row * (1.0 if row[np.argmax(np.abs(row))] >= 0 else -1.0) for row in loadings])
    total = float(values.sum()) or 1.0
    return Components(moments.names, tuple(map(float, moments.mean)), tuple(tuple(map(float, row)) for row in loadings),
                      tuple(float(max(values[i], 0.0)) / total for i in order))


def _explained(moments: Moments) -> list[float]:
    """Cumulative explained variance of the standardised features."""
    return list(np.cumsum(fit_components(moments.moved(moments.mean, moments.deviation)).variance))


def variance_curve(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(component, cumulative): explained variance of the standardised features."""
    rows = [(i, float(c)) for i, c in enumerate(_explained(Moments.of(df, names)), start=1)]
    return df.sparkSession.createDataFrame(rows, "component int, cumulative double")


def component_count(moments: Moments, legacy_count: bool = False) -> int:
    """Smallest number of components that explains 80 % of the variance; ``legacy_count`` takes one less, at least 1."""
    curve = _explained(moments)
    reaching = next(i for i, c in enumerate(curve, start=1) if c > VARIANCE_SHARE or i == len(curve))
    return max(reaching - 1, 1) if legacy_count else reaching


def project(df: DataFrame, names: Sequence[str], components: int | list[list[str]] | None,
            legacy_count: bool = False, moments: Moments | None = None) -> tuple[DataFrame, list[str]]:
    """Replace the features by principal components ``pc0, pc1, ...``; one aggregate fits all of them.

    ``components``: a count, a list of feature subsets (one component each, a single feature is passed through), or
    None for as many as explain 80 % of the variance.
    """
    m = moments or Moments.of(df, names)
    if isinstance(components, list):
        columns = [F.col(subset[0]) if len(subset) == 1 else fit_components(m.only(subset), 1).column(0) for subset in components]
    else:
        k = component_count(m, legacy_count) if components is None else components
        model = fit_components(m, k)
        columns = [model.column(i) for i in range(k)]
    out = [f"pc{i}" for i in range(len(columns))]
    return df.withColumns(dict(zip(out, columns))), out


def preprocess(df: DataFrame, names: Sequence[str], *, standardization: bool = False, normalization: bool = False,
               norm: bool = False, pca: bool = False,
               components: int | list[list[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """Scaling steps in fixed order (standardise, min-max, unit norm), then components. Returns the feature names.

    The features are scaled copies ``x_<name>``; the original columns stay. The first two steps and the components
    follow from the moments of the input, which one aggregate reads; only components of unit-length rows need another.
    """
    features = [f"x_{n}" for n in names]
    out = df.withColumns({f"x_{n}": F.col(n).cast("double") for n in names})
    moments = None
    if standardization or normalization or (pca and not norm):
        moments = Moments.of(df, names).moved(np.zeros(len(names)), np.ones(len(names)), features)
    if standardization:
        out, moments = standardize(out, features, moments), moments.moved(moments.mean, moments.deviation)
    if normalization:
        out, moments = min_max(out, features, moments), moments.moved(moments.low, moments.span)
    if norm:
        out, moments = unit_norm(out, features), None
    if not pca:
        return out, features
    subsets = [[f"x_{n}" for n in s] for s in components] if isinstance(components, list) else components
    projected, pcs = project(out, features, subsets, moments=moments)
    return projected.drop(*features), pcs
