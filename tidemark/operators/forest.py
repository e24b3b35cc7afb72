"""Trees of one key as flat arrays: rows walk them together, and a block of rows leaves its partial sums.

What a task does with a block of rows for :mod:`tidemark.operators.trees`. A row costs one step per level and
member, whatever the number of nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 8192
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """One more long for Spark's ``xxhash64`` (unsigned 64 bits in and out)."""
    h = seed + _P5 + np.uint64(8)
    h = h ^ (_rotated(value.astype(np.int64).view(np.uint64) * _P2, 31) * _P1)
    return _mixed(_rotated(h, 27) * _P1 + _P4)


def hash_int(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """One more int for Spark's ``xxhash64``."""
    h = seed + _P5 + np.uint64(4)
    h = h ^ (value.astype(np.int32).view(np.uint32).astype(np.uint64) * _P1)
    return _mixed(_rotated(h, 23) * _P2 + _P3)


def poisson_weights(mean: float, hashes: np.ndarray) -> np.ndarray:
    """``trees.poisson_weight`` of these hashes."""
    p, total, totals = math.exp(-mean), 0.0, []
    for k in range(int(mean + 8 * math.sqrt(mean)) + 2):
        total += p
        totals.append(total)
        p *= mean / (k + 1)
    u = (hashes & np.uint64((1 << 52) - 1)).astype(np.float64) / float(1 << 52)
    return np.searchsorted(np.array(totals), u, side="right").astype(np.float64)


def feature_subsets(n_features: int, chosen: int, hashes: np.ndarray) -> np.ndarray:
    """``trees.feature_subset`` for each hash of what comes before the feature."""
    if chosen >= n_features:
        return np.broadcast_to(np.arange(n_features), (len(hashes), n_features))
    drawn = hash_int(np.arange(n_features)[None, :], hashes[:, None]).view(np.int64)
    return np.argsort(drawn, axis=1, kind="stable")[:, :chosen]


class Tree:
    """Slots 0 to ``inner`` - 1 are splits, the others leaves."""

    def __init__(self, node: np.ndarray, feature: np.ndarray, threshold: np.ndarray, guess: np.ndarray, has_guess: np.ndarray):
        order = np.argsort(node, kind="stable")
        node, feature, threshold, guess, has_guess = (a[order] for a in (node, feature, threshold, guess, has_guess))
        split = feature >= 0
        inside = node[split]
        self.inner = len(inside)
        self.feature, self.threshold = feature[split], threshold[split]
        # children of the splits, left and right in turn; a child without a split of its own is a leaf
        below = (2 * inside[:, None] + np.array([1, 2])).ravel() if self.inner else np.zeros(1, dtype=np.int64)
        self.child = np.arange(self.inner, self.inner + len(below))
        place, found = _places(inside, below)
        self.child[found] = place[found]
        self.node = np.concatenate([inside, below])
        place, found = _places(node[has_guess], self.node)
        self.guess = np.full(len(self.node), np.nan)
        self.guess[found] = guess[has_guess][place[found]]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Slot of the leaf of each row. Missing and NaN features go right."""
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x)) if self.inner else np.zeros(0, dtype=np.int64)
        while len(rows):
            here = at[rows]
            right = ~(x[rows, self.feature[here]] < self.threshold[here])
            at[rows] = here = self.child[2 * here + right]
            rows = rows[here < self.inner]
        return at


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each wanted value among sorted known ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return place, known[place] == wanted


def _filled(column: pa.ChunkedArray, blank: float | int) -> np.ndarray:
    return column.fill_null(blank).to_numpy()


def forest(model: pa.Table, members: int) -> tuple[list[Tree], np.ndarray]:
    """The trees of a key and their votes. A member without rows (just replaced) stands at its root."""
    member, node = _filled(model["member"], -1), _filled(model["node"], -1)
    feature, threshold = _filled(model["feature"], -1), _filled(model["threshold"], 0.0)
    guess, has_guess = _filled(model["g"], 0.0), model["g"].is_valid().to_numpy()
    vote, has_vote = _filled(model["vote"], 0.0), model["vote"].is_valid().to_numpy()
    trees, votes = [], np.ones(members)
    for m in range(members):
        own = member == m
        voted = own & has_vote
        if voted.any():
            votes[m] = vote[voted][0]
        own &= node >= 0
        trees.append(Tree(node[own], feature[own], threshold[own], guess[own], has_guess[own]))
    return trees, votes


def features_matrix(column: pa.ChunkedArray, n_features: int) -> np.ndarray:
    """(rows, n_features); nulls and missing elements as NaN."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    if (sizes == n_features).all():
        return flat.reshape(len(lists), n_features)
    x = np.full((len(lists), n_features), np.nan)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, kept = np.repeat(np.arange(len(lists)), sizes), place < n_features
    x[row[kept], place[kept]] = flat[kept]
    return x


def majority(guesses: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """Class (NaN: none) with the most votes per row of (rows, members) guesses; ties to the smaller class."""
    out = np.full(len(guesses), np.nan)
    known = ~np.isnan(guesses)
    classes = np.unique(guesses[known])
    if not len(classes):
        return out
    for start in range(0, len(guesses), SLICE):
        few, there = guesses[start : start + SLICE], known[start : start + SLICE]
        tally = np.full((len(few), len(classes)), -1.0)
        for m in range(guesses.shape[1]):
            rows = np.flatnonzero(there[:, m])
            cls = np.searchsorted(classes, few[rows, m])
            tally[rows, cls] = np.maximum(tally[rows, cls], 0.0) + votes[m]
        out[start : start + SLICE] = np.where(there.any(axis=1), classes[tally.argmax(axis=1)], np.nan)
    return out


def average(guesses: np.ndarray) -> np.ndarray:
    """Mean of the known guesses per row, NaN without any."""
    known = ~np.isnan(guesses)
    total = np.zeros(len(guesses))
    for m in range(guesses.shape[1]):
        total += np.where(known[:, m], guesses[:, m], 0.0)
    with np.errstate(invalid="ignore"):
        return total / known.sum(axis=1)


def bins_of(x: np.ndarray, bins: int) -> np.ndarray:
    return np.clip(np.floor(np.nan_to_num(x * bins, nan=0.0)), 0, bins - 1).astype(np.int64)


def sums_by(code: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The codes that occur and, for each, the sums of ``weights``."""
    size = int(code.max()) + 1 if len(code) else 0
    if size > 4 * len(code):
        seen, code = np.unique(code, return_inverse=True)
        return seen, [np.bincount(code, w) for w in weights]
    seen = np.flatnonzero(np.bincount(code, minlength=size)) if len(code) else np.zeros(0, dtype=np.int64)
    return seen, [np.bincount(code, w, minlength=size)[seen] for w in weights]


def histograms(
    tree: Tree, at: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, subsets: np.ndarray, bins: int, cls: np.ndarray
) -> Iterator[dict[str, np.ndarray]]:
    """Partial sums of a member's leaves: their mass (f -1), and per chosen feature and bin."""
    names, cls = np.unique(cls, return_inverse=True)
    k, chosen = len(names), subsets.shape[1]
    weights = [w, w * y, w * y * y]

    def cells(leaf: np.ndarray, f: np.ndarray, bin_: np.ndarray, c: np.ndarray, sums: list[np.ndarray]) -> dict[str, np.ndarray]:
        return {"node": tree.node[leaf], "f": f, "bin": bin_, "cls": names[c], "w": sums[0], "sy": sums[1], "syy": sums[2]}

    seen, sums = sums_by(at * k + cls, weights)
    yield cells(seen // k, np.full(len(seen), -1), np.zeros(len(seen), dtype=np.int64), seen % k, sums)
    for j in range(chosen):
        b = bins_of(x[np.arange(len(x)), subsets[at, j]], bins)
        seen, sums = sums_by((at * bins + b) * k + cls, weights)
        leaf = seen // (bins * k)
        yield cells(leaf, subsets[leaf, j], seen // k % bins, seen % k, sums)


def grain_groups(n: np.ndarray, error: np.ndarray, grain: int) -> dict[str, np.ndarray]:
    """Last position, sum and squared deviation of each full group of ``grain`` errors."""
    known = ~np.isnan(error)
    n, error = n[known], error[known]
    group = (n - 1) // grain
    seen, (count, total) = sums_by(group - group.min(), [np.ones(len(n)), error]) if len(n) else (group, [group, group])
    if not len(n):
        return {"n": n, "sy": error, "syy": error}
    place = np.searchsorted(seen, group - group.min())
    spread = np.bincount(place, (error - (total / count)[place]) ** 2, minlength=len(seen))
    full = count == grain
    return {"n": ((seen + group.min() + 1) * grain)[full], "sy": total[full], "syy": spread[full]}
