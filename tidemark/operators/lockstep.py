"""The test-then-train run of many keys side by side: step ``t`` takes the ``t``-th row of every key, as arrays.

Each class here is the array form of a row-by-row one (``Scaler``, ``Adwin``, ``Linear``, ``Neighbours``, ``KeyedTree``,
``KeyedForest``, ``TestThenTrain``) and does the same operations on the same values in the same order, so that every
digit is that of the row form. A *lane* is one detector, model or tree. What the arrays do not cover (ragged or missing
features, three and more labels in trees, custom learners, few keys, one key far longer than the others) goes through the row form.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.functions.vectors import LARGEST
from tidemark.operators.adwin import CLOCK, MAX_BUCKETS, MIN_SIDE, MIN_WIDTH
from tidemark.operators.keyed_trees import BINS, DRIFT_DELTA, GRACE_ROWS, POISSON_MEAN, SPLIT_DELTA, TIE, WARN_DELTA
from tidemark.operators.learners import ENSEMBLE_SIZE, HINGE, MEMORY_ROWS, NEIGHBOURS, PASSIVE_AGGRESSIVE, PERCEPTRON, SQUARED
from tidemark.operators.preprocess import WARMUP_ROWS

WINDOW_BYTES = 64 << 20  # rows of whole keys that a task holds at once
MOST_KEYS = 2048
LARGEST_TARGET = 1e100  # beyond it squares overflow, which the row form reports


@lru_cache(1 << 16)
def _bound(n: int, delta: float) -> float:
    return math.log(2.0 * math.log(n) / delta)


class Detectors:
    """``Adwin`` with a grain of one: bucket ``j`` of level ``k`` of a lane is ``total[k][lane, j]``, absent ones are zero."""

    def __init__(self, lanes: int, delta: float | np.ndarray):
        self.delta = np.zeros(lanes) + delta
        self.width, self.seen = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.sum, self.m2 = np.zeros(lanes), np.zeros(lanes)
        self.total: list[np.ndarray] = []
        self.spread: list[np.ndarray] = []
        self.held: list[np.ndarray] = []

    def reset(self, lanes: np.ndarray, delta: float | None = None) -> None:
        for cells in (self.width, self.seen, self.sum, self.m2, *self.total, *self.spread, *self.held):
            cells[lanes] = 0
        if delta is not None:
            self.delta[lanes] = delta

    def update(self, lanes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Insert a value into each of ``lanes``; 0, 1 or -1 for each, as ``Adwin.update``."""
        width, total = self.width[lanes], self.sum[lanes]
        gap = values - total / np.maximum(width, 1)
        self.m2[lanes] = np.where(width > 0, self.m2[lanes] + width * gap * gap / (width + 1), 0.0)
        width += 1
        self.width[lanes], self.sum[lanes] = width, total + values
        at, size, level, new, spread = lanes, 1, 0, values, 0.0
        while at.size:
            if level == len(self.total):
                self.total.append(np.zeros((len(self.width), MAX_BUCKETS + 1)))
                self.spread.append(np.zeros((len(self.width), MAX_BUCKETS + 1)))
                self.held.append(np.zeros(len(self.width), np.int64))
            place = self.held[level][at]
            self.total[level][at, place], self.spread[level][at, place] = new, spread
            full = place == MAX_BUCKETS
            self.held[level][at] = np.where(full, place - 1, place + 1)
            at = at[full]
            if not at.size:
                break
            s, q = self.total[level][at], self.spread[level][at]
            gap = (s[:, 0] - s[:, 1]) / size
            new, spread = s[:, 0] + s[:, 1], q[:, 0] + q[:, 1] + size * gap * gap / 2
            for cells, old in ((self.total, s), (self.spread, q)):
                old[:, :-2], old[:, -2:] = old[:, 2:].copy(), 0.0
                cells[level][at] = old
            size, level = size * 2, level + 1
        seen = self.seen[lanes] + 1
        self.seen[lanes] = seen
        direction = np.zeros(len(lanes), np.int8)
        due = np.flatnonzero((seen % CLOCK == 0) & (width > MIN_WIDTH))
        while due.size:
            found = self._cut(lanes[due])
            due = due[found != 0]
            direction[due] = found[found != 0]
            self._drop_oldest(lanes[due])
        return direction

    def _cut(self, lanes: np.ndarray) -> np.ndarray:
        n = self.width[lanes]
        bound = np.array([_bound(w, d) if w > MIN_WIDTH else math.inf for w, d in zip(n.tolist(), self.delta[lanes].tolist())])
        spread = self.m2[lanes] / np.maximum(n, 1)
        levels = range(len(self.total) - 1, -1, -1)
        sizes = np.concatenate([(np.arange(MAX_BUCKETS) < self.held[k][lanes][:, None]) << k for k in levels], axis=1)
        totals = np.concatenate([self.total[k][lanes, :MAX_BUCKETS] for k in levels], axis=1)
        n0, s0 = np.cumsum(sizes, axis=1), np.cumsum(totals, axis=1)
        n1 = n[:, None] - n0
        may = (n0 >= MIN_SIDE) & (n1 >= MIN_SIDE) & (n > MIN_WIDTH)[:, None]
        n0, n1 = np.where(may, n0, 1), np.where(may, n1, 1)
        inverse = 1.0 / n0 + 1.0 / n1
        gap = (self.sum[lanes][:, None] - s0) / n1 - s0 / n0
        limit = np.sqrt(2.0 * inverse * spread[:, None] * bound[:, None]) + 2.0 / 3.0 * inverse * bound[:, None]
        over = may & (np.abs(gap) > limit)
        first = over.argmax(axis=1)
        rows = np.arange(len(lanes))
        return np.where(over[rows, first], np.where(gap[rows, first] > 0, 1, -1), 0)

    def _drop_oldest(self, lanes: np.ndarray) -> None:
        for level in range(len(self.total) - 1, -1, -1):
            if not lanes.size:
                return
            has = self.held[level][lanes] > 0
            at, lanes = lanes[has], lanes[~has]
            if not at.size:
                continue
            size = 1 << level
            total, m2 = self.total[level][at, 0], self.spread[level][at, 0]
            for cells in (self.total, self.spread):
                old = cells[level][at]
                old[:, :-1], old[:, -1] = old[:, 1:].copy(), 0.0
                cells[level][at] = old
            self.held[level][at] -= 1
            width, left = self.width[at] - size, self.sum[at] - total
            gap = np.where(width > 0, total / size - left / np.maximum(width, 1), 0.0)
            self.width[at], self.sum[at] = width, left
            self.m2[at] = np.maximum(0.0, self.m2[at] - m2 - size * width * gap * gap / (width + size))


class LinearLanes:
    """``Linear`` for each key."""

    def __init__(self, keys: int, features: int, loss: str, eta: float = 0.01, schedule: str = "inverse", power: float = 0.25, c: float = 1.0):
        self.loss, self.eta, self.schedule, self.power, self.c = loss, eta, schedule, power, c
        self.w, self.b, self.t = np.zeros((features, keys)), np.zeros(keys), np.zeros(keys, np.int64)
        self.rates = np.empty(0)

    def _rate(self, t: np.ndarray) -> float | np.ndarray:
        if self.schedule == "constant":
            return self.eta
        need = int(t.max()) + 1
        if need > len(self.rates):
            more = [self.eta / max(i, 1) ** self.power for i in range(len(self.rates), 2 * need)]
            self.rates = np.concatenate([self.rates, more])
        return self.rates[t]

    def _score(self, x: np.ndarray, at: Any) -> np.ndarray:
        total = np.zeros(len(x))
        for f, w in enumerate(self.w):
            total += w[at] * x[:, f]
        return total + self.b[at]

    def predict(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(0, len(x))
        score = self._score(x, at)
        return (score if self.loss == SQUARED else (score > 0).astype(float)), self.t[at] > 0

    def learn(self, x: np.ndarray, y: np.ndarray, t: int, at: np.ndarray) -> None:
        if not at.size:
            return
        x, y = x[at], y[at]
        self.t[at] += 1
        score, rate = self._score(x, at), self._rate(self.t[at])
        if self.loss == SQUARED:
            step = -rate * (score - y)
        else:
            sign = np.where(y > 0.5, 1.0, -1.0)
            margin = sign * score
            if self.loss == HINGE:
                step = np.where(margin < 1, rate * sign, 0.0)
            elif self.loss == PERCEPTRON:
                step = np.where(margin <= 0, rate * sign, 0.0)
            else:
                norm = np.ones(len(x))
                for f in range(x.shape[1]):
                    norm += x[:, f] * x[:, f]
                step = sign * np.minimum(self.c, np.maximum(0.0, 1.0 - margin) / norm)
        for f, w in enumerate(self.w):
            w[at] += step * x[:, f]
        self.b[at] += step

    def reset(self, keys: np.ndarray) -> None:
        self.w[:, keys], self.b[keys], self.t[keys] = 0.0, 0.0, 0


class NeighbourLanes:
    """``Neighbours`` for each key: the rows learned are those from ``first`` on, at most ``memory``, read in place."""

    def __init__(self, keys: int, features: int, task: str, longest: int, k: int = NEIGHBOURS, memory: int = MEMORY_ROWS):
        self.task, self.k, self.memory = task, k, memory
        self.x, self.y = np.zeros((features, keys, longest)), np.zeros((keys, longest))
        self.first = np.zeros(keys, np.int64)

    def predict(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        known, out = self.first[: len(x)] < t, np.zeros(len(x))
        many = max(1, (1 << 18) // max(1, min(t, self.memory)))
        for start in range(0, len(x), many):
            part = slice(start, min(start + many, len(x)))
            if known[part].any():
                out[part] = self._nearest(x[part], part, t)
        return out, known

    def _nearest(self, x: np.ndarray, part: slice, t: int) -> np.ndarray:
        first = np.maximum(self.first[part], t - self.memory)
        start = min(int(first.min()), t - 1)
        distance = np.zeros((len(x), t - start))
        for f, column in enumerate(self.x):
            gap = column[part, start:t] - x[:, f, None]
            distance += gap * gap
        absent = np.arange(start, t) < first[:, None]
        some = absent.any()
        if some:
            distance[absent] = np.inf
        size, k = t - first, self.k
        if t - start > k:
            # the nearest, in order of age; equal distances go to the older row
            reach = np.partition(distance, k - 1, axis=1)[:, k - 1, None]
            near, level = distance < reach, distance == reach
            left = k - near.sum(axis=1)
            if (level.sum(axis=1) > left).any():
                level &= np.cumsum(level, axis=1) <= left[:, None]
            place = np.nonzero(near | level)[1].reshape(len(x), k)
        else:
            place = np.broadcast_to(np.arange(t - start), distance.shape)
        rows = np.arange(len(x))[:, None]
        place = place[rows, np.argsort(distance[rows, place], axis=1, kind="stable")]
        labels = self.y[part, start:t][rows, place]
        count = np.minimum(size, k)
        # absent rows are infinitely far and older than all others: they come after those at a finite distance
        if some:
            here = ~absent[rows, place]
            order = np.argsort(~here, axis=1, kind="stable")
            labels, here = labels[rows, order], here[rows, order]
        else:
            here = np.ones(labels.shape, bool)
        if self.task == "regression":
            return exact_sum(labels, here) / np.maximum(count, 1)
        votes = ((labels[:, :, None] == labels[:, None, :]) & here[:, None, :]).sum(axis=2)
        votes[~here] = 0
        most = votes == votes.max(axis=1)[:, None]
        return np.where(most & here, labels, np.inf).min(axis=1)

    def learn(self, x: np.ndarray, y: np.ndarray, t: int, at: np.ndarray) -> None:
        self.x[:, : len(x), t], self.y[: len(x), t] = x.T, y
        if len(at) < len(x):
            out = np.ones(len(x), bool)
            out[at] = False
            self.first[np.flatnonzero(out)] = t + 1

    def reset(self, keys: np.ndarray) -> None:
        self.first[keys] = self.now

    def starts(self, t: int) -> None:
        self.now = t


def exact_sum(values: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Row sums as the built-in ``sum`` makes them: with the rounding errors carried along."""
    high, low = np.zeros(len(values)), np.zeros(len(values))
    for x, known in zip(values.T, here.T):
        x = np.where(known, x, 0.0)
        total = high + x
        low += np.where(np.abs(high) >= np.abs(x), (high - total) + x, (x - total) + high)
        high = total
    return np.where(np.isfinite(low), high + low, high)


_LOGS = np.array([0.0, *(math.log2(i) for i in range(1, 1 << 16))])


def _weighted_logs(count: np.ndarray) -> np.ndarray:
    """count * log2(count), 0 for nothing; counts are whole numbers."""
    return count * _log2(count)


def _log2(count: np.ndarray) -> np.ndarray:
    whole = count.astype(np.int64)
    logs = _LOGS[np.minimum(whole, len(_LOGS) - 1)]
    for i in zip(*np.nonzero(whole >= len(_LOGS))):
        logs[i] = math.log2(count[i])
    return logs


def _entropies(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and entropy of two classes (last axis)."""
    total = counts[..., 0] + counts[..., 1]
    logs = _weighted_logs(counts[..., 0]) + _weighted_logs(counts[..., 1])
    return total, np.where(total > 0, _log2(total) - logs / np.maximum(total, 1.0), 0.0)


def _deviations(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and standard deviation of (rows, sum, sum of squares)."""
    n = sums[..., 0]
    safe = np.where(n > 0, n, 1.0)
    mean = sums[..., 1] / safe
    return n, np.where(n > 0, np.sqrt(np.maximum(sums[..., 2] / safe - mean * mean, 0.0)), 0.0)


def _cells(x: np.ndarray) -> np.ndarray:
    return np.clip(np.clip(x * BINS, -1, BINS).astype(np.int64), 0, BINS - 1)


class TreeLanes:
    """``KeyedTree`` for each lane. Nodes of all lanes share one store, the sums of leaves another; both are used again."""

    def __init__(self, lanes: int, features: int, labels: np.ndarray | None, share: float = 1.0, seeds: np.ndarray | None = None):
        self.features, self.labels = features, labels  # the labels in ascending order; None: regression
        self.root = np.full(lanes, -1, np.int64)
        self.seeds = seeds
        self.chosen = features if share >= 1 else min(features, int(math.sqrt(features)) + 1)
        self.width = 3 if labels is None else 2
        self.nodes = {n: np.full(0, -1, np.int64) for n in ("feature", "cut", "low", "high", "slot")}
        self.mass, self.since = np.zeros((0, self.width)), np.zeros(0)
        self.cells = np.zeros((0, features, BINS, self.width))
        self.used = np.zeros((0, features), bool)
        self.free_nodes, self.free_slots = np.empty(0, np.int64), np.empty(0, np.int64)
        self.order: dict[int, list[int]] = {}  # nodes of a lane's tree by age, where a subset of the features is drawn

    def _new(self, mass: np.ndarray) -> np.ndarray:
        count = len(mass)
        if count > len(self.free_nodes):
            more = max(count, len(self.nodes["slot"]), 64)
            for name, old in self.nodes.items():
                self.nodes[name] = np.concatenate([old, np.full(more, -1, np.int64)])
            self.free_nodes = np.concatenate([np.arange(len(old) + more - 1, len(old) - 1, -1), self.free_nodes])
        if count > len(self.free_slots):
            have = len(self.since)
            more = max(count, have // 2, 64)
            for name in ("mass", "since", "cells", "used"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros((more, *old.shape[1:]), old.dtype)]))
            self.free_slots = np.concatenate([np.arange(have + more - 1, have - 1, -1), self.free_slots])
        nodes, slots = self.free_nodes[-count:], self.free_slots[-count:]
        self.free_nodes, self.free_slots = self.free_nodes[:-count], self.free_slots[:-count]
        self.nodes["feature"][nodes], self.nodes["slot"][nodes] = -1, slots
        self.mass[slots], self.since[slots], self.cells[slots], self.used[slots] = mass, 0.0, 0.0, False
        return nodes.copy()

    def drop(self, lanes: np.ndarray) -> None:
        """Empty trees."""
        here = self.root[lanes]
        here = here[here >= 0]
        while here.size:
            inner = self.nodes["feature"][here] >= 0
            self.free_nodes = np.concatenate([self.free_nodes, here])
            self.free_slots = np.concatenate([self.free_slots, self.nodes["slot"][here[~inner]]])
            here = np.concatenate([self.nodes["low"][here[inner]], self.nodes["high"][here[inner]]])
        self.root[lanes] = -1
        for lane in lanes.tolist() if self.order else ():
            self.order.pop(lane, None)

    def move(self, source: np.ndarray, target: np.ndarray) -> None:
        """The trees of ``source`` take the place of those of ``target`` and leave empty ones."""
        self.drop(target)
        self.root[target], self.root[source] = self.root[source], -1
        if self.seeds is not None:
            self.seeds[target] = self.seeds[source]
        for a, b in zip(source.tolist(), target.tolist()) if self.order else ():
            if a in self.order:
                self.order[b] = self.order.pop(a)

    def _find(self, lanes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The leaf of each lane that its row falls into; the trees are not empty."""
        node = self.root[lanes]
        feature = self.nodes["feature"][node]
        on = np.flatnonzero(feature >= 0)
        while on.size:
            here = node[on]
            high = cell[on, feature[on]] > self.nodes["cut"][here]
            node[on] = np.where(high, self.nodes["high"][here], self.nodes["low"][here])
            feature[on] = self.nodes["feature"][node[on]]
            on = on[feature[on] >= 0]
        return node

    def predict(self, lanes: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prediction and leaf of each lane; no leaf (-1) where there was no row yet."""
        node = np.full(len(lanes), -1, np.int64)
        known = self.root[lanes] >= 0
        if known.all():
            node = self._find(lanes, cell)
        else:
            node[known] = self._find(lanes[known], cell[known])
        if not known.any():
            return np.zeros(len(lanes)), node
        mass = self.mass[self.nodes["slot"][node]]  # of an arbitrary leaf where there is none
        if self.labels is None:
            return mass[:, 1] / np.where(mass[:, 0] > 0, mass[:, 0], 1.0), node
        return self.labels[(mass[:, 1] > mass[:, 0]).astype(np.int64)], node

    def learn(self, lanes: np.ndarray, node: np.ndarray, cell: np.ndarray, values: np.ndarray) -> None:
        """``node``: the leaves of the rows, ``values``: what a row adds to its leaf; its first value or their sum is the weight."""
        empty = node < 0
        if empty.any():
            node = node.copy()
            node[empty] = self.root[lanes[empty]] = self._new(np.zeros((int(empty.sum()), self.width)))
            if self.chosen < self.features:
                self.order.update((lane, [n]) for lane, n in zip(lanes[empty].tolist(), node[empty].tolist()))
        slot = self.nodes["slot"][node]
        if self.chosen < self.features:
            for i in np.flatnonzero(~self.used[slot].any(axis=1)).tolist():
                self.used[slot[i], self._subset(int(lanes[i]), int(slot[i]))] = True
        self.mass[slot] += values
        for f in range(self.features):
            if self.chosen < self.features:
                at = np.flatnonzero(self.used[slot, f])
                self.cells[slot[at], f, cell[at, f]] += values[at]
            else:
                self.cells[slot, f, cell[:, f]] += values
        since = self.since[slot] + (values[:, 0] if self.labels is None else values[:, 0] + values[:, 1])
        due = since >= GRACE_ROWS
        since[due] = 0.0
        self.since[slot] = since
        if due.any():
            self._split(lanes[due], node[due])

    def _subset(self, lane: int, slot: int) -> list[int]:
        """As the row form draws it: by the place of the first node that equals this one."""
        place = 0
        for place, node in enumerate(self.order[lane]):
            if self.nodes["feature"][node] < 0:
                other = self.nodes["slot"][node]
                if other == slot or (not self.used[other].any() and (self.mass[other] == self.mass[slot]).all()):
                    break
        seed = int(self.seeds[lane]) if self.seeds is not None else 0
        return sorted(range(self.features), key=lambda f: zlib.crc32(f"{seed}:{place}:{f}".encode()))[: self.chosen]

    def _split(self, lanes: np.ndarray, node: np.ndarray) -> None:
        slot = self.nodes["slot"][node]
        held = self.cells[slot]  # leaf, feature, bin, value
        spreads = _deviations if self.labels is None else _entropies
        left = np.cumsum(held, axis=2)
        if self.labels is None:
            right = np.zeros_like(held)
            for b in range(1, BINS):  # the sums of the bins behind each cut, added up from the cut on
                right[:, :, :b] += held[:, :, b : b + 1]
        else:
            right = left[:, :, -1:] - left  # whole numbers
        full = (held[..., 0] > 0) if self.labels is None else (held[..., 0] + held[..., 1] > 0)
        behind = (right[..., 0] > 0) if self.labels is None else (right[..., 0] + right[..., 1] > 0)
        total, before = spreads(left[:, :, -1])
        (l, left_spread), (r, right_spread) = spreads(left), spreads(right)
        safe = np.where(total > 0, total, 1.0)
        gain = before[:, :, None] - (l * left_spread + r * right_spread) / safe[:, :, None]
        gain = np.where(full & behind, gain, -np.inf)
        cut = gain.argmax(axis=2)
        rows = np.arange(len(slot))
        best = np.take_along_axis(gain, cut[:, :, None], axis=2)[:, :, 0]
        feature = best.argmax(axis=1)
        top = best[rows, feature]
        best[rows, feature] = -np.inf
        second = best.max(axis=1)
        second = np.where(second == -np.inf, 0.0, second)
        bound = np.sqrt(math.log(1 / SPLIT_DELTA) / (2 * safe[rows, feature]))
        positive = top > 0
        if self.labels is None:
            clear = second / np.where(positive, top, 1.0) < 1 - bound
        else:
            clear = top - second > bound
        do = np.flatnonzero(positive & (clear | (bound < TIE)))
        if not do.size:
            return
        feature, cut, node = feature[do], cut[do, feature[do]], node[do]
        kids = self._new(np.concatenate([left[do, feature, cut], right[do, feature, cut]]))
        low, high = kids[: len(do)], kids[len(do) :]
        self.free_slots = np.concatenate([self.free_slots, self.nodes["slot"][node]])
        for name, value in (("feature", feature), ("cut", cut), ("low", low), ("high", high)):
            self.nodes[name][node] = value
        if self.chosen < self.features:
            for lane, a, b in zip(lanes[do].tolist(), low.tolist(), high.tolist()):
                self.order[lane] += [a, b]


def _values(labels: np.ndarray | None, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What rows of weight ``w`` add to their leaves."""
    if labels is None:
        return np.stack([w, w * y, w * y * y], axis=1)
    return np.stack([np.where(y == labels[0], w, 0.0), np.where(y == labels[0], 0.0, w)], axis=1)


class SingleTrees:
    """One ``KeyedTree`` for each key."""

    def __init__(self, keys: int, features: int, labels: np.ndarray | None):
        self.labels, self.trees = labels, TreeLanes(keys, features, labels)

    def predict(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        self.cell = _cells(x)
        guess, self.node = self.trees.predict(np.arange(len(x)), self.cell)
        return guess, self.node >= 0

    def learn(self, x: np.ndarray, y: np.ndarray, t: int, at: np.ndarray) -> None:
        if at.size:
            values = _values(self.labels, y[at], np.ones(len(at)))
            self.trees.learn(at, self.node[at], self.cell[at], values)

    def reset(self, keys: np.ndarray) -> None:
        self.trees.drop(keys)
        self.node[keys] = -1


_weights: dict[tuple[int, int], np.ndarray] = {}


def poisson_weights(seed: int, row: int, members: int) -> np.ndarray:
    """The weights of a forest's members for its first ``row`` rows or more, as ``KeyedForest`` draws them."""
    table = _weights.get((seed, members), np.zeros((1, members)))
    if row >= len(table):
        p = total = math.exp(-POISSON_MEAN)
        steps = [total]
        for k in range(1, 40):
            p *= POISSON_MEAN / k
            total += p
            steps.append(total)
        hashes = [
            [zlib.crc32(f"{seed}:{i}:{m}".encode()) / 2**32 for m in range(members)]
            for i in range(len(table), max(row + 1, 2 * len(table)))
        ]
        more = np.searchsorted(steps, np.array(hashes), side="right").astype(np.int8)
        table = _weights[(seed, members)] = np.concatenate([table.astype(np.int8), more])
    return table


class Forests:
    """One ``KeyedForest`` for each key: its members lie side by side, the trees they grow in the background behind all members."""

    def __init__(self, keys: int, features: int, labels: np.ndarray | None, members: int = ENSEMBLE_SIZE, seed: int = 1):
        self.labels, self.members, self.seed = labels, members, seed
        self.lanes = keys * members
        self.rows = np.zeros(keys, np.int64)
        self.made = np.tile(np.arange(members), keys)
        self.trees = TreeLanes(2 * self.lanes, features, labels, 0.5, np.tile(self._seed(self.made), 2))
        self.growing = np.zeros(self.lanes, bool)
        self.right, self.seen = np.zeros(self.lanes, np.int64), np.zeros(self.lanes, np.int64)
        self.detectors = Detectors(2 * self.lanes, np.repeat([WARN_DELTA, DRIFT_DELTA], self.lanes))

    def _seed(self, number: np.ndarray) -> np.ndarray:
        return self.seed + 7919 * number

    def predict(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(x), self.members
        self.cell = np.repeat(_cells(x), m, axis=0)
        guess, self.node = self.trees.predict(np.arange(n * m), self.cell)
        self.guess = guess
        votes, known = guess.reshape(n, m), (self.node >= 0).reshape(n, m)
        any_known = known.any(axis=1)
        if self.labels is None:
            return exact_sum(votes, known) / np.maximum(known.sum(axis=1), 1), any_known
        weight = ((self.right[: n * m] + 1) / (self.seen[: n * m] + 2)).reshape(n, m)
        high = votes == self.labels[1]
        for_high = np.cumsum(np.where(known & high, weight, 0.0), axis=1)[:, -1]
        for_low = np.cumsum(np.where(known & ~high, weight, 0.0), axis=1)[:, -1]
        return self.labels[(for_high > for_low).astype(np.int64)], any_known

    def learn(self, x: np.ndarray, y: np.ndarray, t: int, at: np.ndarray) -> None:
        if not at.size:
            return
        m = self.members
        self.rows[at] += 1
        rows = self.rows[at]
        lanes = (at[:, None] * m + np.arange(m)).ravel()
        y = np.repeat(y[at], m)
        node, cell = self.node[lanes], self.cell[lanes]
        known = node >= 0
        here = lanes[known]
        if here.size:
            guess, target = self.guess[here], y[known]
            error = (guess != target).astype(float) if self.labels is not None else np.abs(guess - target)
            self.seen[here] += 1
            if self.labels is not None:
                self.right[here] += guess == target
            alarm = self.detectors.update(np.concatenate([here, here + self.lanes]), np.concatenate([error, error])) > 0
            warned, drifted = alarm[: len(here)], alarm[len(here) :]
            if warned.any():
                new = here[warned]
                new = new[~self.growing[new]]
                self.made[new] += m
                self.growing[new] = True
                self.trees.seeds[new + self.lanes] = self._seed(self.made[new])
                self.detectors.reset(new)
            if drifted.any():
                place = np.flatnonzero(known)[drifted]
                self._replace(here[drifted])
                node[place] = -1
                new = self.trees.root[lanes[place]] >= 0
                node[place[new]] = self.trees._find(lanes[place[new]], cell[place[new]])
        weight = poisson_weights(self.seed, int(rows.max()), m)[rows].ravel().astype(float)
        drawn = np.flatnonzero(weight > 0)
        values = _values(self.labels, y, weight)
        grown = drawn[self.growing[lanes[drawn]]]
        if grown.size:
            spare = lanes[grown] + self.lanes
            found = np.full(len(grown), -1, np.int64)
            has = self.trees.root[spare] >= 0
            found[has] = self.trees._find(spare[has], cell[grown[has]])
            lanes_, node_ = np.concatenate([lanes[drawn], spare]), np.concatenate([node[drawn], found])
            both = np.concatenate([drawn, grown])
            self.trees.learn(lanes_, node_, cell[both], values[both])
        else:
            self.trees.learn(lanes[drawn], node[drawn], cell[drawn], values[drawn])

    def _replace(self, lanes: np.ndarray) -> None:
        """The trees in the background take over; new ones where there is none."""
        fresh = ~self.growing[lanes]
        self.made[lanes] += self.members
        self.trees.seeds[lanes[fresh] + self.lanes] = self._seed(self.made[lanes[fresh]])
        self.trees.move(lanes + self.lanes, lanes)
        self.growing[lanes] = False
        self.right[lanes] = self.seen[lanes] = 0
        self.detectors.reset(np.concatenate([lanes, lanes + self.lanes]))

    def reset(self, keys: np.ndarray) -> None:
        m = self.members
        lanes = (keys[:, None] * m + np.arange(m)).ravel()
        both = np.concatenate([lanes, lanes + self.lanes])
        self.trees.drop(both)
        self.made[lanes] = np.tile(np.arange(m), len(keys))
        self.trees.seeds[both] = np.tile(self._seed(self.made[lanes]), 2)
        self.growing[lanes] = False
        self.right[lanes] = self.seen[lanes] = 0
        self.rows[keys] = 0
        self.detectors.reset(both)
        self.node[lanes] = -1


def _linear(loss: str, **options: Any) -> Callable:
    return lambda keys, features, labels, longest: LinearLanes(keys, features, loss, **options)


# (task, model): array form and the number of keys from which it is faster than the row form
LANES: dict[tuple[str, str], tuple[Callable, int]] = {
    ("classification", "sgd"): (_linear(HINGE), 16),
    ("classification", "perceptron"): (_linear(PERCEPTRON, eta=1.0, schedule="constant"), 16),
    ("classification", "passive_aggressive"): (_linear(PASSIVE_AGGRESSIVE), 16),
    ("regression", "sgd"): (_linear(SQUARED), 16),
    ("regression", "sgd_toy"): (_linear(SQUARED, eta=0.0001, schedule="constant"), 16),
    **{(t, "knn"): (lambda keys, features, labels, longest, t=t: NeighbourLanes(keys, features, t, longest), 8) for t in ("classification", "regression")},
    **{p: (lambda keys, features, labels, longest: SingleTrees(keys, features, labels), 16) for p in (("classification", "hoeffding_tree"), ("regression", "fimtdd"))},
    **{(t, "arf"): (lambda keys, features, labels, longest: Forests(keys, features, labels), 4) for t in ("classification", "regression")},
}


def run_lanes(
    task: str, learner: Any, detection: Any, normalize: bool, features: np.ndarray, actual: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, ...]:
    """``TestThenTrain`` over keys by falling ``lengths``; key ``i`` has the rows from ``starts[i]`` on.

    Returns prediction, whether there is one, error, drift and segment of every row.
    """
    keys, width, n = len(starts), features.shape[1], len(actual)
    prediction, error = np.zeros(n), np.zeros(n)
    known, drifts, segments = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int64)
    low, high = np.full((keys, width), np.nan), np.full((keys, width), np.nan)
    segment, last = np.zeros(keys, np.int64), np.zeros(keys, np.int64)
    detectors = Detectors(keys, detection.delta) if detection else None
    alive = keys - np.searchsorted(lengths[::-1], np.arange(int(lengths[0])), side="right")
    for t in range(int(lengths[0])):
        on = int(alive[t])
        rows = starts[:on] + t
        x, y = features[rows], actual[rows]
        if normalize:
            low[:on], high[:on] = np.fmin(low[:on], x), np.fmax(high[:on], x)
            if t + 1 >= WARMUP_ROWS:
                span = high[:on] - low[:on]
                x = (x - low[:on]) / np.where(span == 0, 1.0, span)
            x = np.where(np.isnan(x), 0.0, np.clip(x, -LARGEST, LARGEST))
        if isinstance(learner, NeighbourLanes):
            learner.starts(t)
        guess, has = learner.predict(x, t)
        miss = (guess != y).astype(float) if task == "classification" else np.abs(guess - y)
        train = np.arange(on)
        if detectors is not None:
            judged = np.flatnonzero(has)
            alarm = judged[detectors.update(judged, miss[judged]) != 0]
            if alarm.size and t + 1 > detection.min_rows:
                drift = alarm[t + 1 - last[alarm] >= detection.cooldown]
                if drift.size:
                    last[drift] = t + 1
                    segment[drift] += 1
                    drifts[rows[drift]] = True
                    learner.reset(drift)
                    detectors.reset(drift, detection.delta if detection.delta_after is None else detection.delta_after)
                    if not detection.train_on_drift:
                        train = np.setdiff1d(train, drift, assume_unique=True)
        learner.learn(x, y, t, train)
        prediction[rows], known[rows], error[rows], segments[rows] = guess, has, miss, segment[:on]
    return prediction, known, error, drifts, segments


def _regular(task: str, model: str, normalize: bool, features: np.ndarray, actual: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Rows that the arrays cover."""
    fine = valid & np.isfinite(actual) & (np.abs(actual) < LARGEST_TARGET)
    if not normalize:
        fine &= np.isfinite(features).all(axis=1)
    if task == "classification":
        linear = model in ("sgd", "perceptron", "passive_aggressive")
        fine &= np.isin(actual, (0.0, 1.0)) if linear else (np.abs(actual) < 1 << 53) & (np.trunc(actual) == actual)
    return fine


def run_keys(
    task: str, model: str, detection: Any, normalize: bool, features: np.ndarray, actual: np.ndarray, valid: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Run the keys whose rows lie between consecutive ``bounds``; which of them were run, and the outputs of all rows."""
    n, width = features.shape
    outputs = (np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n, bool), np.zeros(n, np.int64))
    starts, lengths = bounds[:-1], np.diff(bounds)
    done = np.zeros(len(starts), bool)
    build, least = LANES[(task, model)]
    bad = np.concatenate([[0], np.cumsum(~_regular(task, model, normalize, features, actual, valid))])
    fine = bad[bounds[1:]] == bad[bounds[:-1]]
    two = task == "classification" and model in ("hoeffding_tree", "arf")
    labels = None
    if two:  # trees count two labels; they may differ from window to window
        labels = np.unique(actual[np.repeat(fine, lengths)])
        if len(labels) > 2:
            return done, outputs
        labels = np.concatenate([labels, labels.max(initial=0.0) + np.arange(1, 3)])[:2]
    order = np.flatnonzero(fine)
    order = order[np.argsort(-lengths[order], kind="stable")]
    most = max(least, min(MOST_KEYS, 8192 // max(width, 1)))
    while len(order) >= least:
        longest = lengths[order[least - 1]]
        order = order[lengths[order] <= 4 * longest]  # a longer key would run on alone
        if len(order) < least:
            break
        count = int(np.searchsorted(-lengths[order[:most]], -lengths[order[0]] / 4, side="right"))
        group = order[: max(count, least)]
        order = order[len(group) :]
        learner = build(len(group), width, labels, int(lengths[group[0]]))
        with np.errstate(all="ignore"):
            found = run_lanes(task, learner, detection, normalize, features, actual, starts[group], lengths[group])
        rows = np.concatenate([np.arange(s, s + c) for s, c in zip(starts[group].tolist(), lengths[group].tolist())])
        for out, part in zip(outputs, found):
            out[rows] = part[rows]
        done[group] = True
    return done, outputs


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    coded = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy(zero_copy_only=False)


def _bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where the keys begin, and the number of rows."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for k in keys:
        codes = _codes(table.column(k))
        change |= codes[1:] != codes[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]]) if table.num_rows else np.zeros(1, np.int64)


def _matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Features as a matrix of the commonest width, and the rows that have that width."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    kinds, counts = np.unique(size, return_counts=True)
    width = int(kinds[counts.argmax()])
    valid = size == width
    if width <= 0:
        return np.zeros((len(size), 0)), np.zeros(len(size), bool)
    flat = lists.filter(pa.array(valid)).flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width))
    out[valid] = flat.astype(float).reshape(-1, width)
    return out, valid


def runner(
    make: Callable[[dict], Any], keys: Sequence[str], order: str, detection: Any, normalize: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over rows (keys, ``order``, features, actual) sorted by keys and ``order``.

    Whole keys are held up to ``WINDOW_BYTES`` and run side by side; a key beyond that is run row by row as it comes.
    """
    keys = list(keys)
    types = (pa.float64(), pa.float64(), pa.bool_(), pa.int64())
    names = [*keys, order, "actual", "prediction", "error", "drift", "segment"]

    def by_row(table: pa.Table, machine: Any) -> list[tuple]:
        cells = (table.column(c).to_pylist() for c in (order, "features", "actual"))
        return [machine.step(row) for row in zip(*cells)]

    def batches_of(table: pa.Table, outputs: Sequence[pa.Array]) -> Iterator[pa.RecordBatch]:
        columns = [table.column(c) for c in (*keys, order, "actual")]
        yield from pa.table([*columns, *outputs], names=names).combine_chunks().to_batches(max_chunksize=1 << 15)

    def slow(table: pa.Table, machine: Any) -> Iterator[pa.RecordBatch]:
        if table.num_rows:
            yield from batches_of(table, [pa.array(c, t) for c, t in zip(zip(*by_row(table, machine)), types)])

    def key_at(table: pa.Table, row: int) -> dict:
        return {k: table.column(k)[row].as_py() for k in keys}

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        bounds = _bounds(table, keys)
        kinds = _bounds(table.take(bounds[:-1]), ["task", "model"])
        features, valid = _matrix(table.column("features"))
        actual = pc.cast(table.column("actual"), pa.float64()).to_numpy().astype(float)
        n = table.num_rows
        outputs = (np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n, bool), np.zeros(n, np.int64))
        for first, end in zip(kinds[:-1].tolist(), kinds[1:].tolist()):
            start, stop = int(bounds[first]), int(bounds[end])
            part = slice(start, stop)
            kind = key_at(table, start)
            own = bounds[first : end + 1] - start
            if (kind["task"], kind["model"]) in LANES and features.shape[1]:
                done, found = run_keys(kind["task"], kind["model"], detection, normalize, features[part], actual[part], valid[part], own)
                for out, new in zip(outputs, found):
                    out[part] = new
            else:
                done = np.zeros(end - first, bool)
            for i in np.flatnonzero(~done).tolist():
                a, b = start + int(own[i]), start + int(own[i + 1])
                for row, (guess, error, drift, segment) in enumerate(by_row(table.slice(a, b - a), make(key_at(table, a))), a):
                    known = guess is not None
                    for out, v in zip(outputs, (guess if known else 0.0, known, error if known else 0.0, drift, segment)):
                        out[row] = v
        prediction, known, error, drift, segment = outputs
        hidden = ~known
        yield from batches_of(
            table, [pa.array(prediction, mask=hidden), pa.array(error, mask=hidden), pa.array(drift), pa.array(segment)]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, machine, single = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if machine is not None:  # the rest of a key too long to be held
                both = pa.concat_tables([single, table])
                end = int(_bounds(both, keys)[1]) - 1
                yield from slow(table.slice(0, end), machine)
                if end == table.num_rows:
                    continue
                machine, table = None, table.slice(end)
            held.append(table)
            size += table.nbytes
            if size < WINDOW_BYTES:
                continue
            table = pa.concat_tables(held)
            last = int(_bounds(table, keys)[-2])
            yield from whole(table.slice(0, last))
            table = table.slice(last)
            held, size = [table], table.nbytes
            if size >= WINDOW_BYTES:
                machine, single = make(key_at(table, 0)), table.slice(0, 1).combine_chunks()
                yield from slow(table, machine)
                held, size = [], 0
        if held:
            yield from whole(pa.concat_tables(held))

    return run
