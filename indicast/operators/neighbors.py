"""Further forms of k-NN imputation: a streamed one whose candidates are never shuffled (W5), an
exact one with a pruned index (I1, J8) and an approximate one with hash buckets (I1b).

All fill the cells that :func:`indicast.operators.impute.knn_impute` fills, by
the same distance: the mean of the squared differences over the features that
receiver and donor both have.

**Streamed, with a pruned index (exact).** A tree over the features is fitted to a bounded sample: a node
parts its rows into those without a feature, those up to its median and those above. Every donor
goes to its leaf, and leaves are numbered so that donors with few features, which tend to be the
nearest, come first. Receivers are dealt to slices; a slice and all donors, in order of leaf and key, come to one
task, which keeps the slice and passes the donors through in batches. From the ranges of a
leaf's donors follows a lower bound on their distance to a receiver, whatever features they have: the
squared distances to the ranges, averaged over the features all donors have
and over as many of the others as a donor must have and as lower the mean. Only receivers whose
k-th distance so far it does not exceed are compared with the leaf. What is nearer is merged into
the k best donors a cell has so far, so what leaves the task is k rows a missing
cell, whatever the number of donors and batches, and needs no further aggregate.
Donors travel once per slice, and there is a slice per core, or per ``SLICE_ROWS`` receivers if those are more.
How much is pruned depends on the data: features that are independent of each other
leave less to prune, rows that lie in groups much.

**Hash buckets (approximate).** Rows with the same features are one class, searched for and found once; every class is
in the index. Donors are hashed by the cuts of a tree as above to buckets of about ``BUCKET_ROWS`` classes; of each bucket the ranges of
its donors are known, and a receiver asks the ``PROBES`` buckets whose ranges are nearest to it over the features that both have.
What is found in a bucket is compared exactly, so the work of a receiver is bounded, whatever the number of
donors, up to ``MAX_LEAVES`` buckets of that size; beyond, buckets grow. Receivers are dealt to slices in the order of their own buckets, and a bucket's
donors travel to the slices that ask it; they stream by as above, so k rows a cell leave a task.
A receiver with hardly any features is near to most buckets; it asks tables instead. A table is a set S of features with as many
random projections of them, cut to cells; a donor is in the tables of which it
has all features, a receiver asks those of which it has all, in its own cell and
the next one of each projection. The features both have need not be S, and a donor with few
features is more likely to have just these, so where a cell would
hold more than twice ``BUCKET_ROWS`` donors a table takes those with fewest features
only. Sets hold up to three features, as many as keep cells small, and those receivers ask tables that have no more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicast.operators.impute import (
    _PARTIAL_SCHEMA, DIST_DIGITS, DONORS_PER_TASK, KEYS, RECEIVERS_PER_TASK, _any, _column_means, _compared, _filled,
    _nearest, _safe_names, _sq_dist, _top_k,
)
from indicast.schema import IMPUTE, INDICATOR_IDS
from indicast.session import materialize

#: Rows the pivots and the projections are fitted to (every row is indexed).
SAMPLE_ROWS = 20_000
LEAF_ROWS = 512
MAX_LEAVES = 4_096
BUCKET_ROWS = 512
MAX_SETS = 64
PROBES = 96
PROBING_ROWS = 25_000  # receivers of a slice that asks buckets
SLICE_ROWS = 100_000
PIECE_ROWS = 1_024  # donors of a leaf compared at a time
_BATCH = 4_096  # receivers whose bounds are worked out together
_SLAB = 256  # receivers compared with a piece of donors at a time
_PROBED = 64  # receivers whose nearest leaves are worked out together
RESULT_CELLS = 8_192  # cells whose lists leave a task together


def _sample(wide: DataFrame, cols: list[str], rows: int, by: list[str] = KEYS) -> tuple[np.ndarray, int]:
    """At most ``rows`` donors' features, chosen by a hash of their keys (or ``by``), and the number of donors."""
    donors = wide.where(_any(cols, lambda c: c.isNotNull()))
    chosen = donors.orderBy(F.xxhash64(*by), *by).limit(rows).select(*cols).toPandas()
    return chosen.to_numpy(dtype=float).reshape(-1, len(cols)), donors.count()


# ---------------------------------------------------------------- leaves

@dataclass
class Leaves:
    """What is known of the donors of each leaf: their number, the fewest features one of them
    has, how many have each feature, and its range."""

    ids: np.ndarray
    rows: np.ndarray
    fewest: np.ndarray
    has: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, receivers: np.ndarray) -> np.ndarray:
        """Lower bound on the distance of each receiver to the donors of each leaf
        (infinite where they have no feature in common)."""
        size, (leaves, p) = len(receivers), self.has.shape
        gap = np.full((size, leaves, p), np.inf)
        sure_sum, sure_n = np.zeros((size, leaves)), np.zeros((size, leaves))
        for f in range(p):
            own = receivers[:, f][:, None]
            d = np.maximum(np.maximum(self.low[:, f] - own, own - self.high[:, f]), 0) ** 2
            known = ~np.isnan(d)
            sure = known & (self.has[:, f] == self.rows)
            sure_sum += np.where(sure, d, 0)
            sure_n += sure
            gap[:, :, f] = np.where(known & ~sure, d, np.inf)
        gap.sort(axis=2)
        # A donor has at most as many features that the receiver lacks as there are: the others are common to both.
        common = self.fewest - np.isnan(receivers).sum(axis=1)[:, None]
        best = np.full((size, leaves), np.inf)
        for n in range(p + 1):  # of the features that only some have, the n nearest to their ranges
            if n:
                sure_sum += gap[:, :, n - 1]
            may = (sure_n + n >= np.maximum(common, 1))
            best = np.where(may, np.minimum(best, sure_sum / np.maximum(sure_n + n, 1)), best)
        return best

    def nearest(self, receivers: np.ndarray, n: int) -> np.ndarray:
        """Places of the ``n`` leaves (all, if fewer) nearest to each receiver: by the squared distances to their ranges,
        averaged over the receiver's features with the share of the leaf's donors that have them as weight."""
        if n >= len(self.ids):
            return np.tile(np.arange(len(self.ids), dtype=np.int32), (len(receivers), 1))
        out, share = np.empty((len(receivers), n), np.int32), (self.has / self.rows[:, None]).T
        low, high = (np.nan_to_num(x).T for x in (self.low, self.high))
        for at in range(0, len(receivers), _PROBED):
            part = receivers[at:at + _PROBED]
            own = ~np.isnan(part)
            gaps = np.zeros((len(part), len(self.ids)))
            for f in range(part.shape[1]):
                x = np.nan_to_num(part[:, f])[:, None]
                gap = np.maximum(np.maximum(low[f] - x, x - high[f]), 0)
                gaps += gap * gap * np.where(own[:, f][:, None], share[f], 0)
            weight = own @ share
            gaps = np.where(weight > 0, gaps / np.maximum(weight, 1e-300), np.inf)
            out[at:at + len(part)] = np.argpartition(gaps, n - 1, axis=1)[:, :n]
        return out


def _ranges(values: np.ndarray) -> Leaves:
    """The donors ``values`` as one leaf."""
    there = ~np.isnan(values)
    has = there.sum(axis=0)
    low, high = (np.where(has > 0, f(np.where(there, values, e), axis=0), np.nan) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    return Leaves(np.zeros(1, int), np.array([len(values)]), there.sum(axis=1).min(keepdims=True), has[None], low[None], high[None])


def _not_above(bound: np.ndarray, bar: np.ndarray) -> np.ndarray:
    """The distances are rounded: a bound must exceed them by more than that."""
    return (bound * (1 - 1e-9) - 2 * 10.0 ** -DIST_DIGITS <= bar) & np.isfinite(bound)


def fit_tree(sample: np.ndarray, leaves: int, least: int = 4) -> dict[str, np.ndarray]:
    """About ``leaves`` leaves of rows that look like ``sample``: ``feature`` (-1 in a leaf), ``cut``, ``next``
    (the nodes of rows without the feature, up to the cut and above it) and ``leaf``, by the features their rows have."""
    nodes, inside = [[-1, 0.0, (0, 0, 0)]], {0: np.arange(len(sample))}
    todo, made = [(-len(sample), 0)], 1
    while todo and made < leaves:
        _, at = heappop(todo)
        rows = sample[inside[at]]
        there = ~np.isnan(rows)
        n = np.maximum(there.sum(axis=0), 1)
        mean = np.where(there, rows, 0).sum(axis=0) / n
        spread = (np.where(there, rows - mean, 0) ** 2).sum(axis=0)
        if len(rows) < least or not spread.max(initial=0) > 0:
            continue
        f = int(spread.argmax())
        values = np.sort(rows[there[:, f], f])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            cut = values[np.searchsorted(values, cut) - 1]
        kind = np.where(~there[:, f], 0, np.where(rows[:, f] <= cut, 1, 2))
        first = len(nodes)
        nodes[at] = [f, cut, (first, first + 1, first + 2)]
        own = inside.pop(at)
        for i in range(3):
            nodes.append([-1, 0.0, (first + i,) * 3])
            inside[first + i] = own[kind == i]
            heappush(todo, (-len(inside[first + i]), first + i))
        made += 2
    few = {at: (~np.isnan(sample[rows])).sum(axis=1).mean() if len(rows) else 0.0 for at, rows in inside.items()}
    leaf = np.zeros(len(nodes), int)
    for number, at in enumerate(sorted(few, key=lambda at: (few[at], at))):
        leaf[at] = number
    return {"feature": np.array([n[0] for n in nodes]), "cut": np.array([n[1] for n in nodes], float),
            "next": np.array([n[2] for n in nodes]), "leaf": leaf}


def leaf_of(tree: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    node, at = np.zeros(len(rows), int), np.arange(len(rows))
    while len(rows) and (tree["feature"][node] >= 0).any():
        x = rows[at, np.maximum(tree["feature"][node], 0)]
        node = tree["next"][node, np.where(np.isnan(x), 0, np.where(x <= tree["cut"][node], 1, 2))]
    return tree["leaf"][node]


# Broadcast values are plain containers: workers need no import path for the classes, which come with the functions.

def _route(tree, cols: list[str]):
    def run(parts):
        for part in parts:
            yield part.assign(_leaf=leaf_of(tree.value, part[cols].to_numpy(dtype=float)).astype("int32"))
    return run


# ---------------------------------------------------------------- streamed

class _Running:
    """The k nearest donors so far of every missing cell of a slice."""

    def __init__(self, recv: pd.DataFrame, cols: list[str], k: int, piece_rows: int = PIECE_ROWS):
        self.k, self.piece_rows, self.seen = k, piece_rows, 0
        self.keys = recv["ISO3"].to_numpy(dtype=object), recv["YEAR"].to_numpy()
        self.rows = recv[cols].to_numpy(dtype=float)
        self.missing = np.isnan(self.rows)
        self.n_has = (~self.missing).sum(axis=1)
        self.pairs = np.zeros(len(self.rows), np.int64)
        # Cells are numbered by row; what the k-th donor of a cell is away bounds the rest.
        self.cell = np.cumsum(self.missing.ravel()).reshape(self.missing.shape) - 1
        n = int(self.missing.sum())
        self.dist, self.rank = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max)
        self.best = [np.empty((n, k)), np.empty((n, k), object), np.zeros((n, k), np.int64)]
        self.bars = np.where(self.missing, np.inf, -np.inf)
        self.asking = None
        if "_probes" in recv:  # the receivers by the leaves they ask
            n = recv["_probes"].str.len().to_numpy()
            leaf, row = np.concatenate(recv["_probes"].to_numpy()), np.repeat(np.arange(len(recv), dtype=np.int32), n)
            order = np.argsort(leaf, kind="stable")
            self.asking = leaf[order], row[order]

    def add(self, donors: pd.DataFrame, cols: list[str]) -> None:
        """Merge a batch of donors; ``_rank`` is their place in the order of their keys (that of the batches
        if absent), in which the donors of a ``_leaf`` follow each other."""
        values, n = donors[cols].to_numpy(dtype=float), len(donors)
        rank = donors["_rank"].to_numpy() if "_rank" in donors else self.seen + np.arange(n)
        told = [donors["ISO3"].to_numpy(dtype=object), donors["YEAR"].to_numpy()]
        leaf = donors["_leaf"].to_numpy() if "_leaf" in donors else np.zeros(n, int)
        self.seen += n
        ends = [*(np.flatnonzero(np.diff(leaf)) + 1), n]
        for begin, end in zip([0, *ends], ends):
            for at in range(begin, end, self.piece_rows):
                to = slice(at, min(at + self.piece_rows, end))
                self._compare(values[to], rank[to], [x[to] for x in told], leaf[begin])

    def _near(self, leaf: Leaves, most: int, number: int) -> np.ndarray:
        """The receivers that may have a nearer donor in the leaf than their k-th so far, of those that ask for it."""
        has = leaf.has[0] > 0
        if self.asking is not None:
            near = self.asking[1][slice(*np.searchsorted(self.asking[0], [number, number + 1]))]
            bar = self.bars[np.ix_(near, has)].max(axis=1, initial=-np.inf)
            return near[_not_above(leaf.bounds(self.rows[near])[:, 0], bar)]
        bar = self.bars[:, has].max(axis=1, initial=-np.inf)
        near = np.flatnonzero(bar > -np.inf)
        sure = np.flatnonzero(leaf.has[0] == leaf.rows[0])
        # First by the features all donors have, then by all of them.
        if np.isfinite(bar[near]).any():
            gap = np.zeros(len(self.rows))
            for f in sure:
                own = self.rows[:, f]
                gap += np.nan_to_num(np.maximum(np.maximum(leaf.low[0, f] - own, own - leaf.high[0, f]), 0) ** 2)
            near = near[_not_above(gap[near] / np.maximum(np.minimum(self.n_has[near], most), 1), bar[near])]
        held = [_not_above(leaf.bounds(self.rows[part])[:, 0], bar[part])
                for part in (near[at:at + _BATCH] for at in range(0, len(near), _BATCH))]
        return near[np.concatenate(held)] if held else near

    def _compare(self, values: np.ndarray, rank: np.ndarray, told: list[np.ndarray], number: int = 0) -> None:
        there, k = ~np.isnan(values), self.k
        near = self._near(_ranges(values), int(there.sum(axis=1).max()), number)
        self.pairs[near] += len(values)
        columns = [(j, np.flatnonzero(there[:, j])) for j in range(values.shape[1])]
        for at in range(0, len(near), _SLAB):
            part = near[at:at + _SLAB]
            dist = _sq_dist(self.rows[part], values)
            dist[np.isnan(dist)] = np.inf
            for j, cand in columns:
                rows = np.flatnonzero(self.missing[part, j])
                if not len(rows) or not len(cand):
                    continue
                new = dist[np.ix_(rows, cand)]
                nearer = new.min(axis=1) <= self.bars[part[rows], j]
                rows, new = part[rows[nearer]], new[nearer]
                # Donors stand in order of their keys, so the leftmost of ties has the smallest.
                r, c = np.nonzero(_nearest(new, k))
                if not len(r):
                    continue
                own, place, c_all = self.cell[rows, j], np.arange(len(r)) - np.searchsorted(r, r), cand[c]
                d = np.concatenate([self.dist[own], np.full((len(own), k), np.inf)], axis=1)
                o = np.concatenate([self.rank[own], np.full((len(own), k), np.iinfo(np.int64).max)], axis=1)
                d[r, k + place], o[r, k + place] = new[r, c], rank[c_all]
                order = np.lexsort((o, d), axis=1)[:, :k]
                self.dist[own], self.rank[own] = (np.take_along_axis(x, order, axis=1) for x in (d, o))
                for best, found in zip(self.best, (values[:, j], *told)):
                    both = np.concatenate([best[own], best[own]], axis=1)
                    both[r, k + place] = found[c_all]
                    best[own] = np.take_along_axis(both, order, axis=1)
                self.bars[rows, j] = self.dist[own][:, -1]

    def result(self, pairs: bool = False) -> pd.DataFrame:
        """The k best of every cell and, asked for, the donors each receiver was compared with (J is -1)."""
        return pd.concat(list(self.results(pairs)), ignore_index=True)

    def results(self, pairs: bool = False):
        """The parts of :meth:`result`, ``RESULT_CELLS`` cells or rows at a time."""
        row, j = np.nonzero(self.missing)
        names = zip(("ISO3", "YEAR", "J", "DD", "D_ISO3", "D_YEAR", "V"), ("object", "int32", "int32", "float64", "object", "int32", "float64"))
        names = list(names)

        def frame(*columns) -> pd.DataFrame:
            return pd.DataFrame({n: pd.Series(np.asarray(c, t), dtype=t) for (n, t), c in zip(names, columns)})
        for at in range(0, max(len(row), 1), RESULT_CELLS):
            cells = slice(at, at + RESULT_CELLS)
            r, c = np.nonzero(np.isfinite(self.dist[cells]))
            of = row[cells][r]
            v, iso, year = (x[cells][r, c] for x in self.best)
            yield frame(self.keys[0][of], self.keys[1][of], j[cells][r], self.dist[cells][r, c], iso, year, v)
        if pairs:
            receivers = np.flatnonzero(self.missing.any(axis=1))
            for at in range(0, len(receivers), RESULT_CELLS):
                of = receivers[at:at + RESULT_CELLS]
                none = np.zeros(len(of))
                yield frame(self.keys[0][of], self.keys[1][of], none - 1, self.pairs[of], np.full(len(of), ""), none, none)


def _stream(cols: list[str], k: int, piece_rows: int, pairs: bool):
    def run(parts):
        held, running, own = [], None, None
        for part in parts:
            for number, rows in part.groupby("_slice", sort=False):
                if number != own:
                    if running is not None:
                        yield from running.results(pairs)
                    held, running, own = [], None, number
                recv, donors = rows[rows["_side"] == 0], rows[rows["_side"] == 1]
                if len(recv):
                    held.append(recv)
                if len(donors) and held:
                    running = running or _Running(pd.concat(held), cols, k, piece_rows)
                    running.add(donors, cols)
        if running is not None:
            yield from running.results(pairs)
    return run


def nearest_streamed(wide: DataFrame, k: int, cols0: list[str], slice_rows: int = SLICE_ROWS, leaf_rows: int = LEAF_ROWS,
                     sample_rows: int = SAMPLE_ROWS, piece_rows: int = PIECE_ROWS, pairs: bool = False,
                     asking: Column | None = None) -> DataFrame:
    """As :func:`indicast.operators.impute.nearest_donors`; nothing is shuffled behind the comparison.
    ``asking`` tells the receivers to search for (all, if absent); donors are all rows.
    With ``pairs`` also a row of J = -1 for each receiver, with the number of donors it was compared with as DD."""
    safe, cols = _safe_names(wide, cols0)
    context = wide.sparkSession.sparkContext
    any_null, any_val = _any(cols, lambda c: c.isNull()), _any(cols, lambda c: c.isNotNull())
    any_null = any_null if asking is None else any_null & asking
    n, total = safe.agg(F.count_if(any_null), F.count_if(any_val)).first()
    # As many slices as keep the cores busy, unless they would be small.
    cores = max(1, context.defaultParallelism)
    slices = max(1, -(-n // slice_rows), min(cores, -(-n // 1000)))
    slices = slices if slices <= cores or slice_rows < 1000 else -(-slices // cores) * cores
    own = [*KEYS, *[F.col(c).cast("double").alias(c) for c in cols]]
    plain = safe.select(*own)
    recv = safe.where(any_null).select(*own).withColumns({
        "_slice": F.pmod(F.xxhash64(*KEYS), F.lit(slices)), "_side": F.lit(0), "_leaf": F.lit(0), "_rank": F.lit(0).cast("bigint")})
    # Numbers that rise in the order of the keys.
    dons = plain.where(any_val).orderBy(*KEYS, *cols).withColumn("_rank", F.monotonically_increasing_id())
    leaves = min(MAX_LEAVES, total // leaf_rows)
    if leaves > 1:
        tree = context.broadcast(fit_tree(_sample(safe, cols, sample_rows)[0], leaves))
        dons = dons.mapInPandas(_route(tree, cols), ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in dons.schema.fields] + ["_leaf int"]))
    else:
        dons = dons.withColumn("_leaf", F.lit(0))
    dons = dons.withColumns({
        "_slice": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))), "_side": F.lit(1)})
    both = (recv.unionByName(dons).repartitionById(slices, F.col("_slice").cast("int"))
            .sortWithinPartitions("_slice", "_side", "_leaf", "_rank"))
    return both.mapInPandas(_stream(cols, k, piece_rows, pairs), _PARTIAL_SCHEMA)


def knn_impute_streamed(wide: DataFrame, k: int = IMPUTE.knn_neighbors, cols: list[str] | None = None, **kw) -> DataFrame:
    """I1/W5, exact: the result of ``knn_impute``."""
    cols0 = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    safe, names = _safe_names(wide, cols0)
    return _filled(wide, safe, cols0, nearest_streamed(wide, k, cols0, **kw), _column_means(safe, names))


def knn_impute_pruned(wide: DataFrame, k: int = IMPUTE.knn_neighbors, cols: list[str] | None = None,
                      count_pairs: str | None = None, leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS,
                      receivers_per_task: int = SLICE_ROWS, donors_per_task: int = PIECE_ROWS) -> DataFrame:
    """I1/J8, exact: the result of ``knn_impute``. ``count_pairs`` names a further
    column with the number of donors each row was compared with."""
    cols0 = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    safe, cols = _safe_names(wide, cols0)
    near = nearest_streamed(wide, k, cols0, receivers_per_task, leaf_rows, sample_rows, donors_per_task, bool(count_pairs))
    if not count_pairs:
        return _filled(wide, safe, cols0, near, _column_means(safe, cols))
    near = materialize(near)
    out = _filled(wide, safe, cols0, near.where("J >= 0"), _column_means(safe, cols))
    pairs = near.where("J = -1").select(*KEYS, F.col("DD").cast("bigint").alias(count_pairs))
    return out.join(pairs, KEYS, "left").withColumn(count_pairs, F.coalesce(count_pairs, F.lit(0).cast("bigint")))


# ---------------------------------------------------------------- hash buckets

@dataclass
class Table:
    """Projections of a set of features, cut to cells, and the most features a donor in it may have."""

    features: tuple[int, ...]
    weights: np.ndarray
    offset: np.ndarray
    most: int

    def cells(self, rows: np.ndarray) -> np.ndarray:
        return np.floor(rows[:, self.features] @ self.weights.T + self.offset)


def fit_tables(sample: np.ndarray, total: int, bucket_rows: int = BUCKET_ROWS, seed: int = 42) -> list[Table]:
    """Tables for ``total`` donors that look like ``sample``."""
    rng = np.random.default_rng(seed)
    p = sample.shape[1]
    there = ~np.isnan(sample)
    n_features = there.sum(axis=1)
    scale = np.array([np.ptp(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0.0 for c in sample.T])
    scale[scale == 0] = 1
    weight = total / max(len(sample), 1)  # donors a sample row stands for
    # As many features in a set as give small cells with some 50 values each.
    largest = int(np.clip(np.ceil(np.log(max(total / bucket_rows, 2)) / np.log(50)), 1, 3))
    tables = []
    for size in range(1, largest + 1):
        sets = list(combinations(range(p), size))
        if len(sets) > MAX_SETS:
            sets = [sets[i] for i in sorted(rng.choice(len(sets), MAX_SETS, replace=False))]
        for features in sets:
            has = there[:, features].all(axis=1)
            if not has.any():
                continue
            steps = max(1.0, has.sum() * weight / bucket_rows) ** (1 / size)
            turn = np.linalg.qr(rng.normal(size=(size, size)))[0] if size > 1 else np.ones((1, 1))
            table = Table(features, turn * steps / scale[list(features)], rng.random(size), p)
            _, cell, n = np.unique(table.cells(sample[has]), axis=0, return_inverse=True, return_counts=True)
            cell = cell.ravel()
            # The most features with which a row's own cell holds twice bucket_rows donors at most, on average.
            for most in range(p, size - 1, -1):
                few = n_features[has] <= most
                own = np.bincount(cell[few], minlength=len(n))
                if most == size or (own * n).sum() / n.sum() * weight <= 2 * bucket_rows:
                    table.most = most
                    break
            tables.append(table)
    return tables


def _projected(table: Table, cols: list[str]) -> list[Column]:
    return [reduce(lambda a, b: a + b, [F.col(cols[f]) * F.lit(float(w)) for f, w in zip(table.features, row)]) + F.lit(float(o))
            for row, o in zip(table.weights, table.offset)]


def _buckets(tables: list[Table], cols: list[str], asked: bool) -> Column:
    """The buckets a donor is in or, ``asked``, those a receiver looks up: its own cell of a
    table and for each projection the nearer of the next ones."""
    has = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    out = []
    for t, table in enumerate(tables):
        at = _projected(table, cols)
        cell = [F.floor(x) for x in at]
        ways = [cell]
        if asked:
            ways += [[c + F.when(x - c < 0.5, -1).otherwise(1) if i == j else c for j, c in enumerate(cell)]
                     for i, x in enumerate(at)]
        fits = reduce(lambda a, b: a & b, [F.col(cols[f]).isNotNull() for f in table.features])
        if not asked and table.most < len(cols):
            fits = fits & (has <= table.most)
        out += [F.when(fits, F.xxhash64(F.lit(t), *way)) for way in ways]
    return F.array_distinct(F.array_compact(F.array(*out)))


def _classes(wide: DataFrame, cols: list[str], k: int, asking: Column | None) -> tuple[DataFrame, DataFrame]:
    """The rows with the same features as one class, numbered (``_id``) in the order of its smallest key, with its ``k`` smallest
    keys (``_keys``), and the receivers' keys with the ``_id`` of their class. A row without features has none."""
    own = [F.col(c).cast("double").alias(c) for c in cols]
    known = _any(cols, lambda c: c.isNotNull())
    plain = wide.select(*KEYS, *own).where(known).distinct()
    first = plain.withColumn("_n", F.row_number().over(Window.partitionBy(*cols).orderBy(*KEYS))).where(F.col("_n") <= k)
    classes = materialize(first.groupBy(*cols).agg(F.array_sort(F.collect_list(F.struct("_n", *KEYS))).alias("_keys"))
                          .orderBy(F.struct(*[F.col("_keys")[0][c] for c in KEYS]), *cols)
                          .withColumn("_id", F.monotonically_increasing_id()))
    lacks = _any(cols, lambda c: c.isNull())
    recv = (wide.where(known & (lacks if asking is None else lacks & asking)).select(*KEYS, *own).distinct()
            .select(*KEYS, F.struct(*cols).alias("_v")))
    recv = recv.join(classes.select(F.struct(*cols).alias("_v"), "_id"), "_v").select(*KEYS, "_id")
    return classes, recv


def _probing(leaves, firsts, cols: list[str], probes: int):
    """Receivers with their slice, by their own leaf, and the leaves they ask."""
    def run(parts):
        known = Leaves(*leaves.value)
        first, pieces = firsts.value
        for part in parts:
            if len(part):
                leaf = part["_leaf"].to_numpy()
                number = first[leaf] + part["_rank"].to_numpy() % pieces[leaf]
                asked = known.ids[known.nearest(part[cols].to_numpy(dtype=float), probes)]
                yield part.assign(_slice=number.astype("int64"), _probes=list(asked.astype("int32")))
    return run


def _by_leaves(recv: DataFrame, dons: DataFrame, cols: list[str], k: int, sample: np.ndarray, total: int,
               bucket_rows: int, probes: int, slice_rows: int) -> DataFrame:
    """The k nearest donors in the leaves that a receiver asks."""
    context = recv.sparkSession.sparkContext
    fitted = fit_tree(sample, max(1, min(MAX_LEAVES, -(-total // bucket_rows))))
    tree = context.broadcast(fitted)
    own = [*KEYS, *cols, F.col("_id").alias("_rank")]
    routed = "ISO3 string, YEAR int, " + ", ".join(f"{c} double" for c in cols) + ", _rank bigint, _leaf int"
    dons, recv = (materialize(df.select(*own).mapInPandas(_route(tree, cols), routed)) for df in (dons, recv))
    # One row per leaf comes to the driver.
    some = lambda c: F.when(~F.isnan(c), F.col(c))
    told = dons.groupBy("_leaf").agg(
        F.count("*").alias("rows"), F.min(sum((some(c).isNotNull().cast("int") for c in cols), F.lit(0))).alias("fewest"),
        *[f(some(c)).alias(f"{name}{c}") for name, f in (("has", F.count), ("low", F.min), ("high", F.max)) for c in cols]
    ).orderBy("_leaf").toPandas()
    leaves = context.broadcast(tuple(told[n].to_numpy() for n in ("_leaf", "rows", "fewest")) + tuple(
        told[[f"{name}{c}" for c in cols]].to_numpy(dtype=float) for name in ("has", "low", "high")))
    # Slices of receivers in the order of their leaves; a leaf beyond a slice's size is dealt to several.
    held = recv.groupBy("_leaf").count().toPandas()
    counts = np.zeros(int(fitted["leaf"].max()) + 1, np.int64)
    counts[held["_leaf"]] = held["count"]
    size = max(1, min(slice_rows, max(1000, -(-int(counts.sum()) // max(1, context.defaultParallelism)))))
    pieces = np.maximum(1, -(-counts // size))
    firsts = np.where(pieces > 1, 0, counts).cumsum() // size  # beside the large leaves, about a slice's size each
    small = int(firsts.max()) + 1
    firsts = np.where(pieces > 1, small + np.where(pieces > 1, pieces, 0).cumsum() - pieces, firsts)
    slices = small + int(pieces[pieces > 1].sum())
    recv = materialize(recv.mapInPandas(_probing(leaves, context.broadcast((firsts, pieces)), cols, probes),
                                        routed + ", _slice bigint, _probes array<int>"))
    wanted = recv.select("_slice", F.explode("_probes").alias("_leaf")).distinct()
    dons = dons.join(wanted, "_leaf").withColumns({"_side": F.lit(1), "_probes": F.lit(None).cast("array<int>")})
    both = (recv.withColumn("_side", F.lit(0)).unionByName(dons).repartitionById(slices, F.col("_slice").cast("int"))
            .sortWithinPartitions("_slice", "_side", "_leaf", "_rank"))
    return both.mapInPandas(_stream(cols, k, PIECE_ROWS, False), _PARTIAL_SCHEMA)


def _by_tables(recv: DataFrame, dons: DataFrame, cols: list[str], k: int, tables: list[Table],
               receivers_per_task: int, donors_per_task: int) -> DataFrame:
    """The k nearest donors of each cell that a receiver asks."""
    recv = recv.withColumn("_b", F.explode(_buckets(tables, cols, asked=True)))
    dons = (dons.withColumn("_b", F.explode(_buckets(tables, cols, asked=False)))
            .join(recv.select("_b").distinct(), "_b", "left_semi"))
    # Buckets beyond a task's size: no more of them than rows divided by that size.
    parts = lambda df, size, name: (df.groupBy("_b").agg(F.ceil(F.count("*") / size).alias(name)).where(F.col(name) > 1))
    slices, chunks = parts(recv, receivers_per_task, "_slices"), parts(dons, donors_per_task, "_chunks")
    counted = [df.join(slices, "_b", "left").join(chunks, "_b", "left").fillna(1, ["_slices", "_chunks"]) for df in (recv, dons)]
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    recv = counted[0].withColumn("_slice", F.pmod(F.xxhash64(*KEYS), F.col("_slices"))).withColumn("_chunk", every("_chunks"))
    dons = counted[1].withColumn("_chunk", F.pmod(F.xxhash64(*KEYS, F.lit(7)), F.col("_chunks"))).withColumn("_slice", every("_slices"))
    group = ["_b", "_slice", "_chunk"]
    return _compared(recv.select(*group, *KEYS, *cols), dons.select(*group, *KEYS, *cols), group, cols, k)


def nearest_by_buckets(wide: DataFrame, k: int, cols0: list[str], bucket_rows: int = BUCKET_ROWS,
                       sample_rows: int = SAMPLE_ROWS, receivers_per_task: int = RECEIVERS_PER_TASK,
                       donors_per_task: int = DONORS_PER_TASK, asking: Column | None = None,
                       probes: int = PROBES, slice_rows: int = PROBING_ROWS) -> DataFrame:
    """As :func:`indicast.operators.impute.nearest_donors`, of the donors in the buckets a receiver asks.
    ``asking`` tells the receivers to search for (all, if absent); every donor is in its buckets."""
    safe, cols = _safe_names(wide, cols0)
    classes, keys = _classes(safe, cols, k, asking)
    keys = materialize(keys)
    sample, total = _sample(classes, cols, sample_rows, cols)
    tables = fit_tables(sample, total, bucket_rows)
    few = max((len(t.features) for t in tables), default=0)
    # In the comparison a class goes by its number; its digits sort as the numbers do.
    named = classes.select(F.lpad(F.col("_id").cast("string"), 20, "0").alias("ISO3"), F.lit(0).alias("YEAR"), "_id", *cols)
    recv = named.join(keys.select("_id").distinct(), "_id", "left_semi")
    has = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    again = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])
    found = _by_leaves(recv.where(has > few), again(named), cols, k, sample, total, bucket_rows, probes, slice_rows)
    if tables:
        # A donor may share several buckets with a receiver.
        sparse = _by_tables(recv.where(has <= few), again(named), cols, k, tables, receivers_per_task, donors_per_task)
        found = found.unionByName(sparse.dropDuplicates(["ISO3", "J", "D_ISO3"]))
    # The k nearest keys are those of the k nearest classes.
    best = _top_k(found, k).select(F.col("ISO3").cast("bigint").alias("_id"), "J", "DD", F.col("D_ISO3").cast("bigint").alias("_did"), "V")
    told = best.join(classes.select(F.col("_id").alias("_did"), F.explode("_keys").alias("_key")), "_did").select(
        "_id", "J", "DD", F.col("_key.ISO3").alias("D_ISO3"), F.col("_key.YEAR").alias("D_YEAR"), "V")
    nearest = Window.partitionBy("_id", "J").orderBy("DD", "D_ISO3", "D_YEAR")
    told = told.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k).drop("_n")
    every = keys.join(told, "_id").select(*KEYS, "J", "DD", "D_ISO3", "D_YEAR", "V")
    return _top_k(every.dropDuplicates([*KEYS, "J", "D_ISO3", "D_YEAR"]), k)


def knn_impute_lsh(wide: DataFrame, k: int = IMPUTE.knn_neighbors, cols: list[str] | None = None, **kw) -> DataFrame:
    """I1b, approximate: ``knn_impute`` with the donors in the hash buckets the
    receiver asks. A cell none of whose donors are gets the column's mean."""
    cols0 = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    safe, names = _safe_names(wide, cols0)
    return _filled(wide, safe, cols0, nearest_by_buckets(wide, k, cols0, **kw), _column_means(safe, names))


def recall(exact: DataFrame, found: DataFrame) -> DataFrame:
    """``J, N_CELLS, N_NEIGHBOURS, RECALL``: the share of the exact neighbours for which ``found`` has
    one that is no further away than the cell's last exact neighbour (ties count as equal)."""
    bars = exact.groupBy(*KEYS, "J").agg(F.max("DD").alias("_bar"), F.count("*").alias("_n"))
    joined = bars.join(found.select(*KEYS, "J", "DD"), [*KEYS, "J"], "left")
    cells = joined.groupBy(*KEYS, "J").agg(F.first("_n").alias("_n"), F.count_if(F.col("DD") <= F.col("_bar")).alias("_hits"))
    return cells.groupBy("J").agg(F.count("*").alias("N_CELLS"), F.sum("_n").alias("N_NEIGHBOURS"),
                                  (F.sum(F.least("_hits", "_n")) / F.sum("_n")).alias("RECALL"))


__all__ = ["knn_impute_streamed", "nearest_streamed", "knn_impute_pruned", "knn_impute_lsh", "nearest_by_buckets", "recall"]
