"""Grouping trajectories by extent (spread), by end points (edges), and by both.

Each grouping runs in rounds: choose a centre among the groups that have no id yet, then give the round's number to
every such group inside a box around it. The rounds depend on each other, but the driver holds only the boxes (a few
numbers per round); groups and positions stay distributed. After each batch of rounds the leftover rows are written to the
checkpoint folder, which keeps plans short and lets the tables shrink as ids are given out.

The edge and coordinate rounds of a batch are guessed together: one scan takes the votes of all its starts, counted
per group, and the boxes are then guessed from these counts, each under the boxes last guessed for the starts before it,
until a guess confirms itself. The first unconfirmed start of a guess is always right, and starts far from each other are
right at once, so a batch takes fewer jobs than rounds, with the result of one round after the other. A spread round needs one aggregate: the group nearest to the mean
comes from a list of near groups, as long as the mean has not moved so far that another could be nearer.

The first rounds cover the dense parts, most rounds number a few groups each. Once at most ``REST_GROUPS`` groups are open, be it from
the start or after a batch, the driver holds their measures and runs their rounds itself, with the same rules; the positions stay
distributed and are counted per open group and start, ``REST_PAIRS`` counts in one job at most.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.functions.columns import hash_order
from trailframe.session import materialize, scratch_path

BATCH_ROUNDS = 64
#: Near groups that the driver holds for the spread rounds.
NEAR_GROUPS = 1000
#: Open groups, and counts of their positions, that the driver holds for the last rounds.
REST_GROUPS = 32_768
#: Rounds before that in tables of a few groups; other tables that the driver may hold from the start take none.
FIRST_ROUNDS, FEW_GROUPS = 16, 256
REST_PAIRS = 2_097_152
#: Merged latitude intervals by which a scan of a batch is pruned.
SCAN_INTERVALS = 8
CELL_DEGREES = 0.01
_ORDER = ("server_time", "device_time", "id")


def _point() -> Column:
    return F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


def _spread_aggregates() -> list[Column]:
    return [
        (F.max("latitude") - F.min("latitude")).alias("spread_latitude"),
        (F.max("longitude") - F.min("longitude")).alias("spread_longitude"),
    ]


def group_spread(pos: DataFrame, keys: list[str]) -> DataFrame:
    """Extent of each group in latitude and longitude."""
    return pos.groupBy(*keys).agg(*_spread_aggregates())


def _unpack_edges(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "edge_latitude_start": F.col("_first.lat"), "edge_longitude_start": F.col("_first.lon"),
        "edge_latitude_stop": F.col("_last.lat"), "edge_longitude_stop": F.col("_last.lon"),
    }).drop("_first", "_last")


def _edge_aggregates() -> list[Column]:
    return [
        F.min_by(_point(), F.struct(*_ORDER)).alias("_first"),
        F.max_by(_point(), F.struct(*_ORDER)).alias("_last"),
    ]


def group_edges(pos: DataFrame, keys: list[str]) -> DataFrame:
    """First and last coordinate of each group."""
    return _unpack_edges(pos.groupBy(*keys).agg(*_edge_aggregates()))


def group_moments(pos: DataFrame, keys: list[str]) -> DataFrame:
    """Row count, coordinate mean and sample standard deviation (0 for one row) of each group."""
    deviation = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
    return pos.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("latitude").alias("mean_latitude"), F.avg("longitude").alias("mean_longitude"),
        deviation("latitude").alias("std_latitude"), deviation("longitude").alias("std_longitude"),
    )


def attach(df: DataFrame, groups: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Write per-group columns back to every row of the group.

    The row side may be split by adaptive skew handling, the group side has one row per key. Null keys match each other.
    """
    return _by_key(df.drop(*columns), groups.select(*keys, *columns), keys).select(*df.columns)


def _by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    other = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return left.join(other, match).drop(*[f"_key_{k}" for k in keys])


def _split(groups: DataFrame, measures: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Groups that have all measures, and the ones without (all or their end coordinates null), which get id 0."""
    known = reduce(lambda t, n: t & F.col(n).isNotNull(), measures, F.lit(True))
    return groups.where(known), groups.where(~known)


@dataclass(frozen=True)
class _Box:
    columns: tuple[str, ...]
    centre: tuple[float, ...]
    delta: tuple[float, ...]

    def bounds(self) -> list[tuple[str, float, float]]:
        return [(n, c - d, c + d) for n, c, d in zip(self.columns, self.centre, self.delta)]

    def covers(self, row: Row) -> bool:
        return all(low <= row[n] <= high for n, low, high in self.bounds())


def _same(a: _Box, b: _Box) -> bool:
    """Equal but for the order in which deviations were added up."""
    return a.centre == b.centre and all(math.isclose(x, y, rel_tol=1e-11, abs_tol=1e-18) for x, y in zip(a.delta, b.delta))


def _merged(intervals: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """At most ``SCAN_INTERVALS`` intervals over the given ones, joined across the smallest gaps."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    while len(out) > SCAN_INTERVALS:
        at = min(range(len(out) - 1), key=lambda k: out[k + 1][0] - out[k][1])
        out[at:at + 2] = [(out[at][0], out[at + 1][1])]
    return out


def _first_cover(boxes: dict[int, _Box]) -> Column:
    """The smallest number of a box that covers the row, or null; the boxes are one constant, so plans keep their code."""
    if not boxes:
        return F.lit(None).cast("long")
    columns = next(iter(boxes.values())).columns
    rows = [{"j": j} | {f"{end}{k}": v for k, (_, *ends) in enumerate(box.bounds()) for end, v in zip(("lo", "hi"), ends)}
            for j, box in sorted(boxes.items())]
    fields = ", ".join(f"lo{k}: double, hi{k}: double" for k in range(len(columns)))
    constant = F.from_json(F.lit(json.dumps(rows)), f"array<struct<j: bigint, {fields}>>")
    inside = lambda b: reduce(lambda t, k: t & F.col(columns[k]).between(b[f"lo{k}"], b[f"hi{k}"]), range(len(columns)), F.lit(True))
    return F.get(F.filter(constant, inside), F.lit(0))["j"]


class _Ledger:
    """Groups with and without an id, kept in the checkpoint folder.

    The rounds are one-row aggregates with nothing to adapt at run time, so they run in a sibling session with adaptive
    execution off, which saves a planning step per job.
    """

    def __init__(self, groups: DataFrame, keys: list[str], name: str):
        self.keys, self.name = keys, name
        self.session = groups.sparkSession.newSession()
        for key, value in groups.sparkSession.conf.getAll.items():
            if key.startswith("spark.sql.") and self.session.conf.isModifiable(key):
                self.session.conf.set(key, value)
        self.session.conf.set("spark.sql.adaptive.enabled", "false")
        self.done_path = scratch_path(groups.sparkSession, name)
        self.wrote = False
        self.next_id = 1
        self.left = self.stored(groups)
        self.rows = self.left

    def stored(self, df: DataFrame) -> DataFrame:
        path = scratch_path(df.sparkSession, self.name)
        df.write.parquet(path)
        return self.session.read.schema(df.schema).parquet(path)

    def small(self, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
        """A local table of a number and doubles; from Arrow, so that it is part of the plan and no job makes it."""
        columns = [pa.array([row[k] for row in rows], pa.float64() if k else pa.int64()) for k in range(len(names))]
        return self.session.createDataFrame(pa.table(columns, names=list(names)))

    def near(self, rows: DataFrame, starts: Sequence[Row], measures: Sequence[str]) -> DataFrame:
        """Pairs of a row and a start ``i`` near it: within two standard deviations of the start's mean position.

        The start's own measures come along.
        """
        lat, lon = "latitude", "longitude"
        ranges = [(i, *[v for n in (lat, lon) for v in (s[f"mean_{n}"] - 2 * s[f"std_{n}"], s[f"mean_{n}"] + 2 * s[f"std_{n}"])],
                   *_vector(s, measures)) for i, s in enumerate(starts)]
        fence = " OR ".join(f"{lat} BETWEEN {a!r}D AND {b!r}D" for a, b in _merged([r[1:3] for r in ranges]))
        table = self.small(ranges, ["i", "lat_lo", "lat_hi", "lon_lo", "lon_hi", *[f"o_{n}" for n in measures]])
        inside = F.col(lat).between(F.col("lat_lo"), F.col("lat_hi")) & F.col(lon).between(F.col("lon_lo"), F.col("lon_hi"))
        return rows.where(fence).join(F.broadcast(table), inside)

    def ballots(self, starts: Sequence[Row], measures: Sequence[str]) -> DataFrame:
        """(keys, measures, near): how many rows of each open group lie near which start; one scan for a whole batch."""
        each = self.near(self.rows, starts, measures).groupBy("i", *self.keys).agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for n in measures for c in (n, f"o_{n}")])
        start = F.struct("i", "n", *[f"o_{n}" for n in measures])
        return self.stored(each.groupBy(*self.keys, *measures).agg(F.collect_list(start).alias("near")))  # one entry a start at most

    def vote(self, ballots: DataFrame, first: int, boxes: dict[int, _Box], by: Sequence[str],
             measures: Sequence[str]) -> dict[int, tuple[Row, Row]]:
        """From start ``first`` on: deviations of the voters, and the measures of the voter nearest (L1) to their mean in ``by``.

        The voters of a start are the rows near it that no box with a smaller number covers.
        """
        open_to = F.coalesce(_first_cover(boxes), F.lit(len(boxes) + (max(boxes) if boxes else 0) + BATCH_ROUNDS))
        near = F.filter("near", lambda x: x["i"].between(F.lit(first), open_to))
        voters = ballots.select(*self.keys, *measures, F.inline(near))
        moved = {n: F.col(n) - F.col(f"o_{n}") for n in measures}  # added up around the start, so that no deviation is drowned
        sums = voters.groupBy("i").agg(F.sum("n").alias("_n"), *[F.first(f"o_{n}").alias(f"o_{n}") for n in measures], *[
            f for n in measures for f in (F.sum(F.col("n") * moved[n]).alias(f"_s_{n}"), F.sum(F.col("n") * moved[n] * moved[n]).alias(f"_q_{n}"))])
        square = lambda n: F.greatest(F.col(f"_q_{n}") - F.col(f"_s_{n}") * F.col(f"_s_{n}") / F.col("_n"), F.lit(0.0))
        stats = sums.select("i", *[(F.col(f"o_{n}") + F.col(f"_s_{n}") / F.col("_n")).alias(f"avg_{n}") for n in by],
                            *[F.when(F.col("_n") > 1, F.sqrt(square(n) / (F.col("_n") - 1))).alias(f"std_{n}") for n in measures])
        distance = reduce(lambda t, n: t + F.abs(F.col(n) - F.col(f"avg_{n}")), by, F.lit(0.0))
        best = voters.join(F.broadcast(stats), "i").groupBy("i").agg(
            F.min_by(F.struct(*measures), F.struct(distance.alias("_distance"), *self.keys)).alias("best"),
            *[F.first(f"std_{n}").alias(f"std_{n}") for n in measures]).collect()
        return {row["i"]: (row, row["best"]) for row in best}

    def open(self, boxes: Sequence[_Box]) -> DataFrame:
        """Groups that neither an earlier batch nor ``boxes`` cover."""
        return self.left.where(_first_cover(dict(enumerate(boxes))).isNull())

    def settle(self, boxes: Sequence[_Box]) -> None:
        """Number the groups of a finished batch and keep the others for the next one."""
        first = _first_cover({self.next_id + i: box for i, box in enumerate(boxes)})
        same = self.rows is self.left
        self.left.select(*self.keys, first.alias(self.name)).where(F.col(self.name).isNotNull()).write.mode("append").parquet(self.done_path)
        self.wrote = True
        self.left = self.stored(self.left.where(first.isNull()))
        self.rows = self.left if same else self.stored(self.rows.where(first.isNull()))
        self.next_id += len(boxes)

    def batch_rounds(self) -> int:
        """How many rounds the next batch takes; none when the driver may hold what a batch left open."""
        groups = self.left.count()
        if groups > REST_GROUPS:
            return BATCH_ROUNDS
        return 0 if self.wrote or groups > FEW_GROUPS else min(FIRST_ROUNDS, BATCH_ROUNDS)

    def settle_rest(self, rest: _Rest) -> None:
        """Number the groups whose rounds the driver ran."""
        table = self.session.createDataFrame(rest.table.select(self.keys).append_column(self.name, pa.array(rest.ids)))
        types = dict(self.left.dtypes)
        table.select(*[F.col(k).cast(types[k]) for k in self.keys], self.name).write.mode("append").parquet(self.done_path)
        self.wrote = True
        self.next_id = rest.next_id

    def result(self, spark: SparkSession) -> DataFrame:
        """(keys, id) of every group that took part."""
        rest = self.left.select(*self.keys, F.lit(0).cast("long").alias(self.name))
        if not self.wrote:
            rest.write.parquet(self.done_path)
        return spark.read.schema(rest.schema).parquet(self.done_path)


class _Rest:
    """The groups that are left open, few enough for the driver, in the order of ``by``."""

    def __init__(self, ledger: _Ledger, measures: Sequence[str], by: Sequence[str]):
        self.ledger, self.measures = ledger, tuple(measures)
        table = ledger.left.toArrow()
        self.table = table.take(_sorted(table, by))
        self.rank = np.empty(len(table), dtype=np.int64)  # place in the order of the keys
        self.rank[_sorted(self.table, ledger.keys).to_numpy()] = np.arange(len(table))
        self.values = np.column_stack([self.table[n].to_numpy() for n in measures])
        self.open = np.ones(len(table), dtype=bool)
        self.ids = np.zeros(len(table), dtype=np.int64)
        self.next_id = ledger.next_id

    def nearest(self, groups: np.ndarray, mean: np.ndarray) -> int:
        """Of ``groups``, the one nearest (L1) to a mean of the first measures."""
        distance = reduce(lambda t, k: t + np.abs(self.values[groups, k] - mean[k]), range(len(mean)), 0.0)
        return int(groups[np.lexsort((self.rank[groups], distance))[0]])

    def give(self, centre: int, delta: Sequence[float]) -> None:
        """The next id for the open groups in a box."""
        middle = self.values[centre]
        hit = self.open & ((middle - delta <= self.values) & (self.values <= middle + delta)).all(axis=1)
        self.ids[hit] = self.next_id
        self.open &= ~hit
        self.next_id += 1

    def counts(self, starts: np.ndarray) -> np.ndarray:
        """(groups x starts): how many rows of an open group lie near a start."""
        keys, session = self.ledger.keys, self.ledger.session
        still = np.nonzero(self.open)[0]
        numbers = session.createDataFrame(self.table.select(keys).take(pa.array(still)).append_column("_g", pa.array(still)))
        rows = _by_key(self.ledger.rows.select(*keys, "latitude", "longitude"), F.broadcast(numbers), keys)
        head = [Row(**row) for row in self.table.take(pa.array(starts)).to_pylist()]
        found = self.ledger.near(rows.drop(*keys), head, ()).groupBy("_g", "i").agg(F.count(F.lit(1)).alias("n")).toArrow()
        out = np.zeros((len(self.open), len(starts)), dtype=np.int64)
        out[found["_g"].to_numpy(), found["i"].to_numpy()] = found["n"].to_numpy()
        return out


def _sorted(table: pa.Table, by: Sequence[str]) -> pa.Array:
    return pc.sort_indices(table, sort_keys=[(k, "ascending") for k in by], null_placement="at_start")


def _vector(row: Row, names: Sequence[str]) -> tuple[float, ...]:
    return tuple(float(row[n]) for n in names)


def _deltas(fixed: float | None, stats: Row | None, names: Sequence[str], factor: float) -> tuple[float, ...]:
    if fixed is not None:
        return (float(fixed),) * len(names)
    return tuple(float(stats[f"std_{n}"] or 0.0) * factor if stats else 0.0 for n in names)


def _with_ids(groups: DataFrame, missing: DataFrame, ids: DataFrame, keys: list[str], name: str,
              columns: Sequence[str]) -> DataFrame:
    """(keys, columns, id), with id 0 for groups without measures."""
    out = _by_key(groups.select(*keys, *columns), ids, keys).select(*keys, *columns, name)
    return out.unionByName(missing.select(*keys, *columns, F.lit(0).cast("long").alias(name)))


def spread_ids(pos: DataFrame, keys: list[str], delta: float | None = None) -> DataFrame:
    """(keys, spreads, spreaddelta_id): each round is centred on the group nearest to the mean spread.

    The box half-width is ``delta``, or a quarter of the standard deviation of the groups still without an id.
    """
    groups, missing = _split(materialize(group_spread(pos, keys), "spreads"), S.SPREADS)
    ledger = _Ledger(groups, keys, "spreaddelta_id")
    finished, near = False, _Near(ledger, S.SPREADS)
    while not finished:
        batch = ledger.batch_rounds()
        if not batch:
            ledger.settle_rest(_spread_rest(_Rest(ledger, S.SPREADS, keys), delta))
            break
        boxes: list[_Box] = []
        while len(boxes) < batch:
            stats = ledger.open(boxes).selectExpr(
                "count(*) AS n", *[f"avg({n}) AS avg_{n}" for n in S.SPREADS],
                *[f"stddev_samp({n}) AS std_{n}" for n in S.SPREADS]).collect()[0]
            if stats["n"] == 0:
                finished = True
                break
            best = near.nearest(tuple(stats[f"avg_{n}"] for n in S.SPREADS), boxes)
            boxes.append(_Box(tuple(S.SPREADS), _vector(best, S.SPREADS),
                              _deltas(delta, stats, S.SPREADS, 0.25)))
        if boxes:
            ledger.settle(boxes)
            near.drop(boxes)
    return _with_ids(groups, missing, ledger.result(pos.sparkSession), keys, "spreaddelta_id", S.SPREADS)


def _spread_rest(rest: _Rest, delta: float | None) -> _Rest:
    """The last spread rounds."""
    while rest.open.any():
        groups = np.nonzero(rest.open)[0]
        values = rest.values[groups]
        reach = 0.25 * values.std(axis=0, ddof=1) if len(groups) > 1 else np.zeros(values.shape[1])
        rest.give(rest.nearest(groups, values.mean(axis=0)), reach if delta is None else np.full_like(reach, delta))
    return rest


class _Near:
    """The open group nearest (L1) to a mean that moves from round to round.

    Holds the ``NEAR_GROUPS`` groups nearest to an earlier mean. Any other group is at least as far from that mean as the
    last of them, so a listed group stays the nearest while it is closer than that distance less the mean's move.
    """

    def __init__(self, ledger: _Ledger, measures: Sequence[str]):
        self.ledger, self.measures = ledger, measures
        self.rows: list[Row] = []
        self.origin, self.radius = (), -math.inf

    def nearest(self, mean: tuple[float, ...], boxes: Sequence[_Box]) -> Row:
        found = self._listed(mean, boxes)
        if found is None:
            distance = " + ".join(f"abs({n} - {m!r}D)" for n, m in zip(self.measures, mean))
            order = [F.expr(distance), *self.ledger.keys]
            self.rows = self.ledger.open(boxes).orderBy(*order).limit(NEAR_GROUPS).collect()
            self.origin = mean
            self.radius = self._distance(self.rows[-1], mean) if len(self.rows) == NEAR_GROUPS else math.inf
            return self.rows[0]
        return found

    def drop(self, boxes: Sequence[_Box]) -> None:
        self.rows = [row for row in self.rows if not any(box.covers(row) for box in boxes)]

    def _distance(self, row: Row, mean: tuple[float, ...]) -> float:
        total = 0.0
        for n, m in zip(self.measures, mean):
            total += abs(row[n] - m)
        return total

    def _listed(self, mean: tuple[float, ...], boxes: Sequence[_Box]) -> Row | None:
        rows = [row for row in self.rows if not any(box.covers(row) for box in boxes)]
        if not rows:
            return None
        far = lambda row: (self._distance(row, mean), *[(row[k] is not None, row[k]) for k in self.ledger.keys])
        best = min(rows, key=far)
        moved = sum(abs(a - b) for a, b in zip(mean, self.origin))
        return best if self._distance(best, mean) < (self.radius - moved) * (1 - 1e-9) else None


def _clustered(df: DataFrame) -> DataFrame:
    """Sort by grid cell across the cluster, so that a coordinate box reads only the file parts that overlap it."""
    cell = lambda c: F.floor(F.col(c) / CELL_DEGREES)
    return df.repartitionByRange(cell("latitude"), cell("longitude")).sortWithinPartitions(
        cell("latitude"), cell("longitude"))


def _first_copy(pos_gen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that agree in everything but the group key count once, for the smallest key.

    They are recognised by two 64-bit hashes of the row and its id, so only the columns that vote are shuffled.
    """
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in pos_gen.columns if c not in keys]
    marks = [F.xxhash64(*rest).alias("_h1"), F.xxhash64(F.lit(1), *rest).alias("_h2")]
    voting = ["latitude", "longitude", *[c for c in S.EDGES if c in pos_gen.columns]]
    return pos_gen.groupBy("id", *marks).agg(
        F.min(F.struct(*keys)).alias("_key"), *[F.first(c).alias(c) for c in voting]).select(
        *[F.col(f"_key.{k}").alias(k) for k in keys], *voting)


def _box_rounds(groups: DataFrame, positions: DataFrame, keys: list[str], name: str, edge_delta: float | None,
                spread_delta: float | None, with_spread: bool, seed: int) -> DataFrame:
    measures = [*S.EDGES, *S.SPREADS] if with_spread else list(S.EDGES)
    ordered = groups.withColumn("_order", hash_order(*[F.col(k) for k in keys], seed=seed))
    ledger = _Ledger(ordered, keys, name)
    batch = ledger.batch_rounds()
    located = [*keys, "latitude", "longitude"]
    ledger.rows = ledger.stored(_clustered(positions.select(*located, *measures)) if batch else positions.select(*located))

    def rounds(head: Sequence[Row]) -> tuple[list[_Box], Row]:
        """The boxes of the next rounds and the last start that was looked at."""
        ballots = ledger.ballots(head, measures)

        def guess(boxes: dict[int, _Box]) -> dict[int, _Box]:
            votes, out = ledger.vote(ballots, at, boxes, S.EDGES, measures), {}
            for i in range(at, len(head)):
                stats, best = votes.get(i, (None, head[i]))
                delta = _deltas(edge_delta, stats, S.EDGES, 2.0)
                if with_spread:
                    delta += _deltas(spread_delta, stats, S.SPREADS, 0.25)
                out[i] = _Box(tuple(measures), _vector(best, measures), delta)
            return out

        final: dict[int, _Box] = {}
        guessed: dict[int, _Box] = {}
        at = 0  # starts before this one are decided
        while at < len(head):
            assumed = dict(final)  # of the guessed boxes, those whose start the ones before leave open
            for i in sorted(guessed):
                if i >= at and not any(box.covers(head[i]) for box in assumed.values()):
                    assumed[i] = guessed[i]
            guessed = guess(assumed)
            agreed = True
            while at < len(head) and agreed:
                before, covered = assumed.get(at), any(box.covers(head[at]) for box in final.values())
                if not covered:
                    final[at] = before if before is not None and _same(before, guessed[at]) else guessed[at]
                agreed = final.get(at) is before  # otherwise the later votes assumed something else
                at += 1
        return list(final.values()), head[-1]

    def last_rounds(after: str) -> _Rest:
        """The rounds of the rest, from the first start behind ``after`` on."""
        rest = _Rest(ledger, measures, ["_order"])
        edges, at = len(S.EDGES), int(np.searchsorted(rest.table["_order"].to_numpy(zero_copy_only=False).astype(str), after, "right"))
        several = np.nonzero(rest.table["n"].to_numpy() > 1)[0]
        if ledger.next_id == 1 and len(several):
            at = int(several[0])
        factor = np.array([2.0] * edges + [0.25] * (len(measures) - edges))
        while rest.open.any():
            starts = np.nonzero(rest.open[at:])[0][:max(BATCH_ROUNDS, REST_PAIRS // int(rest.open.sum()))] + at
            counts = rest.counts(starts) if len(starts) else None
            for column, start in enumerate(starts):
                if not rest.open[start]:
                    continue
                voters = np.nonzero(rest.open & (counts[:, column] > 0))[0]
                if not len(voters):
                    voters, n = np.array([start]), np.ones(1)
                else:
                    n = counts[voters, column].astype(float)
                moved, total = rest.values[voters] - rest.values[start], n.sum()
                sums = n @ moved
                square = np.maximum(n @ (moved * moved) - sums * sums / total, 0.0)
                delta = np.sqrt(square / (total - 1)) * factor if total > 1 else np.zeros(len(measures))
                if edge_delta is not None:
                    delta[:edges] = edge_delta
                if spread_delta is not None:
                    delta[edges:] = spread_delta
                rest.give(rest.nearest(voters, (rest.values[start] + sums / total)[:edges]), delta)
            at = int(starts[-1]) + 1 if len(starts) else 0
        return rest

    # Starts follow one hashed order, round after round, and begin again at its end: a group that its own box missed is
    # not tried again before the others. A bounded head of the order is enough for a batch.
    last, finished = "", False
    while not finished:
        if not batch:
            ledger.settle_rest(last_rounds(last))
            break
        head = ledger.left.where(f"_order > '{last}'").orderBy("_order").limit(batch).collect()
        if ledger.next_id == 1:
            several = ledger.left.where("n > 1").orderBy("_order").limit(1).collect()
            head = several + [row for row in head if several and row["_order"] > several[0]["_order"]] or head
        if not head:
            finished, last = not last, ""
            continue
        boxes, end = rounds(head)
        last = end["_order"]
        ledger.settle(boxes)
        batch = ledger.batch_rounds()
    return ledger.result(groups.sparkSession)


def edge_ids(pos_gen: DataFrame, keys: list[str], delta: float | None = None, seed: int = 42) -> DataFrame:
    """(keys, edges, edgedelta_id): each round starts from a pseudo-random open group.

    Positions of open groups within two standard deviations of that group's mean position vote, one vote per position,
    for a mean edge; the nearest group's edge is the centre. The half-width is ``delta`` or twice the voters' edge
    standard deviation. In the first round a group of a single row is not picked while a longer one exists. Groups whose
    first or last coordinate is null get id 0.
    """
    edges = materialize(_by_key(group_edges(pos_gen, keys), group_moments(pos_gen, keys), keys), "edges")
    groups, missing = _split(edges, [*S.EDGES, "mean_latitude", "mean_longitude"])
    rows = _first_copy(_by_key(pos_gen.drop(*S.EDGES), groups.select(*keys, *S.EDGES), keys).select(*pos_gen.columns), keys)
    ids = _box_rounds(groups, rows, keys, "edgedelta_id", delta, None, False, seed)
    return _with_ids(groups, missing, ids, keys, "edgedelta_id", S.EDGES)


def coord_ids(pos_gen: DataFrame, keys: list[str], spread_delta: float | None = None, edge_delta: float | None = None,
              seed: int = 42) -> DataFrame:
    """(keys, coorddelta_id): like ``edge_ids``, but a group must also lie in a spread box around the centre group."""
    extent = pos_gen.groupBy(*keys).agg(*_spread_aggregates(), *_edge_aggregates())
    extent = materialize(_by_key(_unpack_edges(extent), group_moments(pos_gen, keys), keys), "coords")
    groups, missing = _split(extent, [*S.EDGES, *S.SPREADS, "mean_latitude", "mean_longitude"])
    rows = attach(pos_gen, groups, keys, [*S.EDGES, *S.SPREADS])
    ids = _box_rounds(groups, rows, keys, "coorddelta_id", edge_delta, spread_delta, True, seed)
    return _with_ids(groups, missing, ids, keys, "coorddelta_id", [])


def spreaddelta(pos_gen: DataFrame, keys: list[str], delta: float | None = None) -> DataFrame:
    return attach(pos_gen, spread_ids(pos_gen, keys, delta), keys, [*S.SPREADS, "spreaddelta_id"])


def edgedelta(pos_gen: DataFrame, keys: list[str], delta: float | None = None, seed: int = 42) -> DataFrame:
    return attach(pos_gen, edge_ids(pos_gen, keys, delta, seed), keys, [*S.EDGES, "edgedelta_id"])


def coorddelta(pos_gen: DataFrame, keys: list[str], spread_delta: float | None = None,
               edge_delta: float | None = None, seed: int = 42) -> DataFrame:
    return attach(pos_gen, coord_ids(pos_gen, keys, spread_delta, edge_delta, seed), keys, ["coorddelta_id"])


def extents(pos_gen: DataFrame, keys: list[str]) -> DataFrame:
    """Spreads and edges of every group in one aggregate."""
    return _unpack_edges(pos_gen.groupBy(*keys).agg(*_spread_aggregates(), *_edge_aggregates()))
