"""Gradient-boosted trees for binary labels, over a bounded table in memory (``fit``) or from histograms
that may be added up anywhere (``boost``).

Histogram splits, logistic loss, Newton leaf values and monotonic constraints:
for a feature with sign +1 (-1) a split is allowed only if it does not lower
(raise) the prediction, and the children are kept on their side of the middle
value, so the whole model is monotonic in that feature. The fitted trees are
flat node arrays, scored for many rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees in flat arrays; a leaf has feature -1 and points to itself.
    A row goes left where its value is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def leaf(self, x: np.ndarray, root: int = 0) -> np.ndarray:
        """The node of the tree at ``root`` in which each row of ``x`` ends."""
        node, rows = np.full(len(x), root), np.arange(len(x))
        for _ in range(self.depth):
            feature = self.feature[node]
            goes_left = x[rows, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(feature < 0, node, np.where(goes_left, self.left[node], self.right[node]))
        return node

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``."""
        out = np.full(len(x), self.base)
        for root in self.roots:
            out += self.value[self.leaf(x, root)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, smooth: float = 1.0, least: float = 1e-3, min_rows: int = 5) -> Trees:
    """Fit to rows ``x`` with labels ``y`` in 0 and 1; ``signs`` gives each
    feature's constraint: +1, -1 or 0. No rows or one class give a constant."""
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for j in range(width)]
    # Cut between values, so that a threshold is not hit by rounding.
    coded = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)]) if n else None
    margin = np.full(n, base)

    def grow(rows, g, h, level, low, high) -> int:
        at = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        nodes.append([-1, 0.0, at, at, rate * float(np.clip(-gs / (hs + smooth), low, high))])
        if level == depth or len(rows) < 2 * min_rows:
            return at
        best = (least, None)
        for j in range(width):
            k = len(cuts[j])
            if not k:
                continue
            code = coded[rows, j]
            count = np.cumsum(np.bincount(code, minlength=k + 1))[:k]
            gl = np.cumsum(np.bincount(code, weights=g[rows], minlength=k + 1))[:k]
            hl = np.cumsum(np.bincount(code, weights=h[rows], minlength=k + 1))[:k]
            left = np.clip(-gl / (hl + smooth), low, high)
            right = np.clip(-(gs - gl) / (hs - hl + smooth), low, high)
            gain = gl ** 2 / (hl + smooth) + (gs - gl) ** 2 / (hs - hl + smooth) - gs ** 2 / (hs + smooth)
            allowed = (count >= min_rows) & (len(rows) - count >= min_rows)
            if signs[j]:
                allowed &= signs[j] * (right - left) >= 0
            gain = np.where(allowed, gain, -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), (j, i, float(left[i]), float(right[i])))
        if best[1] is None:
            return at
        j, i, lv, rv = best[1]
        goes_left = coded[rows, j] <= i
        middle = (lv + rv) / 2
        bounds = [(low, high), (low, high)]
        if signs[j] > 0:
            bounds = [(low, middle), (middle, high)]
        elif signs[j] < 0:
            bounds = [(middle, high), (low, middle)]
        a = grow(rows[goes_left], g, h, level + 1, *bounds[0])
        b = grow(rows[~goes_left], g, h, level + 1, *bounds[1])
        nodes[at][:4] = [j, float(cuts[j][i]), a, b]
        return at

    def flat() -> Trees:
        table = np.array(nodes, float).reshape(-1, 5)
        return Trees(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int),
                     table[:, 4], np.array(roots, int), depth, base)

    if n and 0 < y.sum() < n:
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            first = len(nodes)
            roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -8.0, 8.0))
            one = flat()
            one.roots, one.base = np.array([first]), 0.0
            margin += one.margin(x)
    return flat()


#: Sums are whole numbers of this part of a row, so that their order does not matter.
UNIT = 1 << 32


def weighted_cuts(values: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """The distinct quantiles that cut rising ``values``, each there ``weight`` times, into ``bins`` parts."""
    reach = np.cumsum(weight)
    at = np.linspace(0, 1, bins + 1)[1:-1] * max(reach[-1] - 1, 0)
    low, high = (values[np.minimum(np.searchsorted(reach, np.floor(at) + i, side="right"), len(values) - 1)] for i in (0, 1))
    return np.unique(low + (high - low) * (at - np.floor(at)))


class HeldRows:
    """Weighted rows in memory for :func:`boost`: a fit takes those rows that are its members."""

    def __init__(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray, members: list[np.ndarray]):
        self.codes, self.y, self.weight, self.members = codes, y, weight, members

    def totals(self) -> list[tuple[float, float]]:
        part = np.rint(self.weight * UNIT).astype(np.int64)
        return [(part[m].sum() / UNIT, part[m & (self.y == 1)].sum() / UNIT) for m in self.members]

    def start(self, bases: list[float]) -> None:
        self.margins = [np.full(len(self.y), b) for b in bases]

    def sums(self, growing: list[Trees], bins: int) -> dict[tuple[int, int], np.ndarray]:
        """By fit and node the weight, gradient and hessian of each feature's codes."""
        out = {}
        for fit, (tree, member, margin) in enumerate(zip(growing, self.members, self.margins)):
            node, p = tree.leaf(self.codes), 1 / (1 + np.exp(-margin))
            parts = [np.rint(v * UNIT) for v in (self.weight, self.weight * (p - self.y), self.weight * (p * (1 - p)))]
            width, last = self.codes.shape[1], len(tree.feature)
            place = (np.arange(width) * last + node[member][:, None]) * bins + self.codes[member]
            hists = np.array([np.bincount(place.ravel(), np.repeat(v[member], width), width * last * bins) for v in parts]
                             ).reshape(3, width, last, bins).transpose(2, 1, 3, 0) / UNIT
            out |= {(fit, int(at)): hists[at] for at in np.unique(node[member])}
        return out

    def advance(self, grown: list[Trees]) -> None:
        for tree, margin in zip(grown, self.margins):
            margin += tree.margin(self.codes)


def boost(rows, cuts: list[np.ndarray], signs: list[int], trees: int, depth: int, rate: float = 0.2, smooth: float = 1.0,
          least: float = 1e-3, min_rows: float = 2) -> list[Trees]:
    """As :func:`fit`, of each fit of ``rows`` (a ``HeldRows``, or what has its methods), whose codes are the
    numbers of ``cuts`` below a value. A level of a tree asks for one set of sums for all its nodes and all fits."""
    bins = max(map(len, cuts), default=0) + 1
    totals = rows.totals()
    bases = [float(np.log((one + 0.5) / (n - one + 0.5))) for n, one in totals]
    rows.start(bases)
    done: list[list[list[float]]] = [[] for _ in totals]
    roots: list[list[int]] = [[] for _ in totals]

    def flat(nodes, roots, base, raw=False) -> Trees:
        t = np.array(nodes, float).reshape(-1, 5)
        feature, cut = t[:, 0].astype(int), t[:, 1]
        if raw:
            cut = np.array([cuts[j][int(c)] if j >= 0 else 0.0 for j, c in zip(feature, cut)])
        return Trees(feature, cut, t[:, 2].astype(int), t[:, 3].astype(int), t[:, 4], np.array(roots, int), depth, base)

    def split(hist: np.ndarray, low: float, high: float):
        n, gs, hs = hist[0].sum(axis=0)
        best = (least, None)
        for j, cut in enumerate(cuts):
            k = len(cut)
            if not k or n < 2 * min_rows:
                continue
            count, gl, hl = np.cumsum(hist[j], axis=0)[:k].T
            left, right = (np.clip(-g / (h + smooth), low, high) for g, h in ((gl, hl), (gs - gl, hs - hl)))
            gain = gl ** 2 / (hl + smooth) + (gs - gl) ** 2 / (hs - hl + smooth) - gs ** 2 / (hs + smooth)
            allowed = (count >= min_rows) & (n - count >= min_rows)
            if signs[j]:
                allowed &= signs[j] * (right - left) >= 0
            gain = np.where(allowed, gain, -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), (j, i, float(left[i]), float(right[i])))
        return best[1]

    alive = [0 < one < n for n, one in totals]
    for _ in range(trees if any(alive) else 0):
        grown = [[[-1, 0.0, 0, 0, 0.0]] for _ in totals]
        bounds = [{0: (-8.0, 8.0)} for _ in totals]  # of the nodes of the last level
        for level in range(depth):
            hists = rows.sums([flat(nodes, [0], 0.0) for nodes in grown], bins)
            below: list[dict] = [{} for _ in totals]
            for (fit, at), hist in sorted(hists.items()):
                if not alive[fit] or at not in bounds[fit]:
                    continue
                nodes, (low, high) = grown[fit], bounds[fit][at]
                if not level:
                    _, gs, hs = hist[0].sum(axis=0)
                    nodes[0][4] = rate * float(np.clip(-gs / (hs + smooth), low, high))
                found = split(hist, low, high)
                if found is None:
                    continue
                j, i, left, right = found
                middle, first = (left + right) / 2, len(nodes)
                nodes[at][:4] = [j, i, first, first + 1]
                nodes += [[-1, 0.0, first, first, rate * left], [-1, 0.0, first + 1, first + 1, rate * right]]
                sides = [(low, middle), (middle, high)]
                below[fit][first], below[fit][first + 1] = sides if signs[j] > 0 else sides[::-1] if signs[j] < 0 else [(low, high)] * 2
            bounds = below
            if not any(below):
                break
        rows.advance([flat(nodes, [0], 0.0) for nodes in grown])
        for fit, nodes in enumerate(grown):
            if alive[fit]:
                first = len(done[fit])
                roots[fit].append(first)
                done[fit] += [[f, c, a + first, b + first, v] for f, c, a, b, v in nodes]
    return [flat(*one, raw=True) for one in zip(done, roots, bases)]
