"""Row-by-row Hoeffding and FIMT-DD trees and adaptive random forests as keyed state.

For many streams side by side (entity keys): each key's trees are small state machines inside the ordered keyed
run. One stream that holds most of the rows belongs to the chunk-synchronous form (:mod:`tidemark.operators.trees`),
which uses the same histograms and split rules.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from typing import Any

from tidemark.operators.adwin import Adwin

BINS = 16
GRACE_ROWS = 50
SPLIT_DELTA = 1e-3
TIE = 0.05
POISSON_MEAN = 6.0
WARN_DELTA, DRIFT_DELTA = 0.01, 0.001


def _entropy(counts: Sequence[float]) -> float:
    total = sum(counts)
    return math.log2(total) - sum(c * math.log2(c) for c in counts if c > 0) / total if total > 0 else 0.0


def _deviation(n: float, s: float, q: float) -> float:
    return math.sqrt(max(q / n - (s / n) * (s / n), 0.0)) if n > 0 else 0.0


class KeyedTree:
    """One tree; features lie in [0, 1] (values outside fall into the first or last bin).

    A leaf counts classes (or rows, sum and sum of squares of the target) in total and per bin of its features. Every
    ``GRACE_ROWS`` of weight it is split where the Hoeffding bound allows. No prediction before the first row.
    """

    def __init__(self, task: str, features: float = 1.0, seed: int = 0):
        self.task, self.share, self.seed = task, features, seed
        self.nodes: list[dict[str, Any]] = []

    def _leaf(self, mass: dict[str, Any]) -> int:
        self.nodes.append({"mass": mass, "cells": {}, "since": 0.0})
        return len(self.nodes) - 1

    def _find(self, x: Sequence[float]) -> dict[str, Any]:
        node = self.nodes[0]
        while "cut" in node:
            node = self.nodes[node["kids"][self._bin(x[node["feature"]]) > node["cut"]]]
        return node

    @staticmethod
    def _bin(v: float) -> int:
        return min(max(int(v * BINS), 0), BINS - 1)

    def _add(self, mass: dict[str, float], y: float, w: float) -> None:
        if self.task == "classification":
            mass[str(int(y))] = mass.get(str(int(y)), 0.0) + w
        else:
            for name, v in (("n", w), ("s", w * y), ("q", w * y * y)):
                mass[name] = mass.get(name, 0.0) + v

    def predict(self, x: Sequence[float]) -> float | None:
        mass = self._find(x)["mass"] if self.nodes else {}
        if not mass:
            return None
        if self.task == "classification":
            return float(min(mass, key=lambda c: (-mass[c], int(c))))
        return mass["s"] / mass["n"]

    def _chosen(self, place: int, size: int) -> list[int]:
        count = size if self.share >= 1 else min(size, int(math.sqrt(size)) + 1)
        if count == size:
            return list(range(size))
        return sorted(range(size), key=lambda f: zlib.crc32(f"{self.seed}:{place}:{f}".encode()))[:count]

    def learn(self, x: Sequence[float], y: float, w: float = 1.0) -> None:
        if not self.nodes:
            self._leaf({})
        leaf = self._find(x)
        if "features" not in leaf:
            leaf["features"] = self._chosen(self.nodes.index(leaf), len(x))
        self._add(leaf["mass"], y, w)
        for f in leaf["features"]:
            self._add(leaf["cells"].setdefault(str(f), {}).setdefault(str(self._bin(x[f])), {}), y, w)
        leaf["since"] += w
        if leaf["since"] >= GRACE_ROWS:
            leaf["since"] = 0.0
            self._split(leaf)

    @staticmethod
    def _merged(cells: Sequence[dict[str, float]]) -> dict[str, float]:
        out: dict[str, float] = {}
        for cell in cells:
            for k, v in cell.items():
                out[k] = out[k] + v if k in out else v
        return out

    def _spread(self, mass: dict[str, float]) -> tuple[float, float]:
        """Weight and impurity."""
        if self.task == "classification":
            return sum(mass.values()), _entropy(list(mass.values()))
        return mass.get("n", 0.0), _deviation(mass.get("n", 0.0), mass.get("s", 0.0), mass.get("q", 0.0))

    def _split(self, leaf: dict[str, Any]) -> None:
        best = []
        for f in leaf["features"]:
            held = leaf["cells"][str(f)]
            cuts = [b for b in range(BINS) if str(b) in held]
            cells = [held[str(b)] for b in cuts]
            total, before = self._spread(self._merged(cells))
            left: dict[str, float] = {}
            found = None
            for i, cut in enumerate(cuts[:-1]):
                left, right = self._merged((left, cells[i])), self._merged(cells[i + 1 :])
                (l, left_spread), (r, right_spread) = self._spread(left), self._spread(right)
                gain = before - (l * left_spread + r * right_spread) / total
                if r > 0 and (found is None or gain > found[0]):
                    found = (gain, -cut, f, left, right)
            if found:
                best.append((found, total))
        if not best:
            return
        best.sort(key=lambda b: (-b[0][0], b[0][2]))
        (gain, cut, feature, left, right), total = best[0]
        second = best[1][0][0] if len(best) > 1 else 0.0
        span = math.log2(max(len(leaf["mass"]), 2)) if self.task == "classification" else 1.0
        bound = math.sqrt(span * span * math.log(1 / SPLIT_DELTA) / (2 * total))
        if self.task == "classification":
            clear = gain - second > bound
        else:
            clear = gain > 0 and second / gain < 1 - bound
        if gain > 0 and (clear or bound < TIE):
            leaf.update(feature=feature, cut=-cut, kids=[self._leaf(left), self._leaf(right)])
            del leaf["cells"], leaf["mass"]

    def to_state(self) -> dict[str, Any]:
        return {"nodes": self.nodes}

    def from_state(self, state: dict[str, Any]) -> None:
        self.nodes = state["nodes"]


class KeyedForest:
    """Trees on Poisson-weighted rows and feature subsets.

    A member whose errors raise a warning grows a tree in the background, which takes its place at a drift. Votes weigh by
    the members' accuracy (classification) or equally.
    """

    def __init__(self, task: str, members: int, seed: int = 1):
        self.task, self.seed, self.rows = task, seed, 0
        self.members = [self._member(i) for i in range(members)]

    def _tree(self, number: int) -> KeyedTree:
        return KeyedTree(self.task, 0.5, self.seed + 7919 * number)

    def _member(self, number: int) -> dict[str, Any]:
        return {"tree": self._tree(number), "spare": None, "right": 0, "seen": 0, "made": number,
                "warn": Adwin(WARN_DELTA), "drift": Adwin(DRIFT_DELTA)}

    def predict(self, x: Sequence[float]) -> float | None:
        votes = [(m["tree"].predict(x), (m["right"] + 1) / (m["seen"] + 2)) for m in self.members]
        votes = [v for v in votes if v[0] is not None]
        if not votes:
            return None
        if self.task == "regression":
            return sum(v for v, _ in votes) / len(votes)
        total: dict[float, float] = {}
        for v, w in votes:
            total[v] = total.get(v, 0.0) + w
        return min(total, key=lambda v: (-total[v], v))

    def _weight(self, member: int) -> int:
        u = zlib.crc32(f"{self.seed}:{self.rows}:{member}".encode()) / 2**32
        k, p = 0, math.exp(-POISSON_MEAN)
        total = p
        while u >= total and k < 40:
            k += 1
            p *= POISSON_MEAN / k
            total += p
        return k

    def learn(self, x: Sequence[float], y: float) -> None:
        self.rows += 1
        for number, m in enumerate(self.members):
            guess = m["tree"].predict(x)
            if guess is not None:
                error = float(guess != y) if self.task == "classification" else abs(guess - y)
                m["seen"] += 1
                m["right"] += self.task == "classification" and guess == y
                if m["warn"].update(error) > 0 and m["spare"] is None:
                    m["made"] += len(self.members)
                    m["spare"], m["warn"] = self._tree(m["made"]), Adwin(WARN_DELTA)
                if m["drift"].update(error) > 0:
                    fresh = m["spare"] or self._tree(m["made"] + len(self.members))
                    m.update(self._member(m["made"] + len(self.members)), tree=fresh)
            weight = self._weight(number)
            if weight:
                m["tree"].learn(x, y, weight)
                if m["spare"] is not None:
                    m["spare"].learn(x, y, weight)

    def to_state(self) -> dict[str, Any]:
        plain = []
        for m in self.members:
            trees = {k: m[k] and {**m[k].to_state(), "seed": m[k].seed} for k in ("tree", "spare")}
            detectors = {k: m[k].to_state() for k in ("warn", "drift")}
            plain.append({**m, **trees, **detectors})
        return {"rows": self.rows, "members": plain}

    def from_state(self, state: dict[str, Any]) -> None:
        self.rows, self.members = state["rows"], []
        for saved in state["members"]:
            m = {**self._member(0), **{k: saved[k] for k in ("right", "seen", "made")}}
            for k in ("tree", "spare"):
                m[k] = saved[k] and KeyedTree(self.task, 0.5, saved[k]["seed"])
                if m[k]:
                    m[k].from_state(saved[k])
            for k in ("warn", "drift"):
                m[k].from_state(saved[k])
            self.members.append(m)
