"""Trees and linear models on arrays: the work that training and importance do inside a task.

Columns are those of the model vector, taken together by feature: a number is one column, a categorical feature one
code instead of a column per slot. These functions are sent to tasks by value, so executors need NumPy and PyArrow only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

CHUNK_ROWS = 65_536  # rows that are worked on at a time, so that their columns stay in the processor's cache
NO_VARIANCE = 2.0**-52  # a node whose values vary less is a leaf


@dataclass
class Layout:
    """Features of the model vector: numbers, then slots per categorical feature (a code past the last one is unseen)."""

    numbers: list[str]
    slots: dict[str, list[str]]

    def columns(self) -> list[str]:
        return [*self.numbers, *[f"{name}_slot" for name in self.slots]]

    def starts(self) -> list[int]:
        """First column of every feature in the model vector."""
        sizes = self.sizes()
        return [sum(sizes[:i]) for i in range(len(sizes))]

    def sizes(self) -> list[int]:
        return [1] * len(self.numbers) + [len(labels) for labels in self.slots.values()]

    def width(self) -> int:
        return sum(self.sizes())

    def arrays(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """One array per feature: numbers as they are, categorical features as codes."""
        found = []
        for name in self.numbers:
            values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isnan(values).any():
                raise ValueError(f"Feature {name} has values that are missing or no number.")
            found.append(values)
        for name, labels in self.slots.items():
            codes = pc.index_in(batch.column(f"{name}_slot"), value_set=pa.array(labels, pa.string()))
            found.append(codes.fill_null(len(labels)).to_numpy(zero_copy_only=False))
        return found


@dataclass
class Tree:
    """A binary tree as a heap: children of `i` are `2i + 1` and `2i + 2`.

    `feature` is -1 for leaves. A number goes left up to the threshold `at`, a categorical feature goes left unless
    its code is `at`. `stats` are rows, sum and sum of squares (unknown below the last split: NaN) of what was learned from.
    """

    feature: np.ndarray
    at: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @classmethod
    def leaf(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n), np.full((n, 3), np.nan))

    def goes_right(self, node: int, column: np.ndarray, n_numbers: int) -> np.ndarray:
        return column > self.at[node] if self.feature[node] < n_numbers else column == self.at[node]

    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 2

    def ends(self) -> np.ndarray:
        """The leaf for every sequence of turns, written as a binary number with a digit per level."""
        found = np.zeros(1 << self.depth(), np.intp)
        for level in range(self.depth()):
            turns = np.arange(len(found)) >> (self.depth() - 1 - level) & 1
            found = np.where(self.feature[found] < 0, found, 2 * found + 1 + turns)
        return found

    def turns(self, rights: Callable[[int], np.ndarray], rows: int) -> np.ndarray:
        """The sequence of turns of every row, whose leaf `ends` names; `rights` tells the rows that go right at a node."""
        codes = np.zeros(rows, np.uint8 if self.depth() <= 8 else np.uint32)
        for taken in self._taken(0, self.depth(), rights):
            codes <<= 1
            if taken is not None:
                codes |= taken.view(np.uint8)
        return codes

    def _taken(self, node: int, levels: int, rights: Callable[[int], np.ndarray]) -> list[np.ndarray | None]:
        """Right or left of every row for each level from a node on, None for left throughout.

        Both children are followed for all rows: whole columns of truth values cost less than to pick rows.
        """
        if not levels or self.feature[node] < 0:
            return [None] * levels
        right = rights(node)
        below = zip(self._taken(2 * node + 2, levels - 1, rights), self._taken(2 * node + 1, levels - 1, rights))
        return [right, *[_either(right, a, b) for a, b in below]]

    def nodes(self, columns: Sequence[np.ndarray], n_numbers: int) -> np.ndarray:
        """The leaf of every row."""
        return self.ends()[
            self.turns(lambda node: self.goes_right(node, columns[self.feature[node]], n_numbers), len(columns[0]))
        ]


def _either(which: np.ndarray, a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    """`a` where `which` holds, else `b`; None is false throughout."""
    if a is None:
        return None if b is None else b > which
    return a & which if b is None else b ^ ((a ^ b) & which)


def residual(loss: str, y: np.ndarray, predicted: np.ndarray) -> np.ndarray:
    """What the next tree learns: the loss's negative slope. Labels of the logistic loss are -1 and 1."""
    if loss == "squared":
        return 2.0 * (y - predicted)
    return 4.0 * y / (1.0 + np.exp(2.0 * y * predicted))


# Some training rows: bins per feature, labels, predictions so far, and how many of them, the first, learn; the others watch.
# Tasks pass on plain tuples, as the classes of this module are not known by name there.
Chunk = tuple[np.ndarray, np.ndarray, np.ndarray, int]
# Sums over rows: per node of a level and bin (rows, sum), per node the sum of squares, error and number of watching rows.
Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


def chunks_of(
    batches: Iterator[pa.RecordBatch], layout: Layout, thresholds: list[np.ndarray], target: str, watching: str | None, loss: str
) -> Iterator[Chunk]:
    """Rows as chunks. A number's bin is how many thresholds lie below it."""

    def chunk(held: list[pa.RecordBatch]) -> Chunk:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        columns = layout.arrays(rows)
        y = rows.column(target).to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isnan(y).any():
            raise ValueError(f"Target {target} has missing values.")
        watches = rows.column(watching).to_numpy(zero_copy_only=False).astype(bool) if watching else np.zeros(len(y), bool)
        order = np.argsort(watches, kind="stable")
        widest = max([len(t) for t in thresholds] + [len(labels) for labels in layout.slots.values()])
        bins = np.empty((len(columns), len(y)), np.uint8 if widest < 256 else np.uint16)
        for f, column in enumerate(columns):
            bins[f] = (np.searchsorted(thresholds[f], column, "left") if f < len(thresholds) else column)[order]
        y = y[order] if loss == "squared" else (2.0 * y[order] - 1.0).astype(np.int8)
        return bins, y, np.zeros(len(y)), int(len(y) - watches.sum())

    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, CHUNK_ROWS - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == CHUNK_ROWS:
                yield chunk(held)
                held, n = [], 0
    if held:
        yield chunk(held)


def grown(chunk: Chunk, more: Sequence[tuple[Tree, float]], n_numbers: int) -> Chunk:
    """The chunk with more (binned) trees in its predictions."""
    bins, y, predicted, n_train = chunk
    predicted = predicted.copy()
    for tree, weight in more:
        predicted += weight * tree.value[tree.nodes(bins, n_numbers)]
    return bins, y, predicted, n_train


def added(a: Sums, b: Sums) -> Sums:
    return tuple(x + y for x, y in zip(a, b))


def counted(chunks: Iterator[Chunk], tree: Tree, level: int, sizes: list[int], n_numbers: int, loss: str, first: bool) -> Iterator[Sums]:
    """Sums of a task for the nodes of a level. The first tree learns the labels themselves."""
    n_nodes, total = 1 << level, None
    ends = np.cumsum([0, *sizes])
    for all_bins, labels, predicted, n in chunks:
        r = labels[:n] if first else residual(loss, labels[:n], predicted[:n])
        bins = all_bins[:, :n]
        node = tree.nodes(bins, n_numbers) - (n_nodes - 1)
        if (node < 0).any():  # rows in leaves of earlier levels have come to their end
            live = node >= 0
            node, r, bins = node[live], r[live], bins[:, live]
        sums = np.empty((2, n_nodes, ends[-1]))
        for f, size in enumerate(sizes):
            key = node * size
            key += bins[f]
            span = slice(ends[f], ends[f + 1])
            sums[0, :, span] = np.bincount(key, minlength=n_nodes * size).reshape(n_nodes, size)
            sums[1, :, span] = np.bincount(key, weights=r, minlength=n_nodes * size).reshape(n_nodes, size)
        watched = np.array([np.sum((labels[n:] - predicted[n:]) ** 2), float(len(labels) - n)])
        one = sums, np.bincount(node, weights=r * r, minlength=n_nodes), watched
        total = one if total is None else added(total, one)
    if total is not None:
        yield total


def split_level(tree: Tree, level: int, sums: Sums, sizes: list[int], n_numbers: int, least_rows: int) -> bool:
    """Split the nodes of a level where that lowers the variance most, the first such place on a tie. False if none was."""
    (all_rows, all_values), squares, _ = sums
    first_node, any_split = (1 << level) - 1, False
    ends = np.cumsum([0, *sizes])
    for i in range(1 << level):
        node = first_node + i
        if node and tree.feature[(node - 1) // 2] < 0:
            continue
        count, total = all_rows[i, : sizes[0]].sum(), all_values[i, : sizes[0]].sum()
        mean = total / max(count, 1.0)
        tree.stats[node] = count, total, squares[i]
        tree.value[node] = mean
        if squares[i] / max(count, 1.0) - mean * mean < NO_VARIANCE:
            continue
        best = (0.0, -1, 0, 0.0, 0.0)
        for f, size in enumerate(sizes):
            rows, values = all_rows[i, ends[f] : ends[f + 1]], all_values[i, ends[f] : ends[f + 1]]
            if f < n_numbers:  # left are all bins up to one
                left_rows, left_sum = np.cumsum(rows)[:-1], np.cumsum(values)[:-1]
            else:  # right is one code; that of unseen values, the last, is no column of the vector
                left_rows, left_sum = count - rows[:-1], total - values[:-1]
            right_rows = count - left_rows
            fits = (left_rows >= least_rows) & (right_rows >= least_rows)
            if not fits.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, (left_sum - left_rows * mean) ** 2 / left_rows / right_rows, -1.0)
            place = int(np.argmax(gain))
            if gain[place] > best[0] * (1 + 1e-12):  # equal splits differ by rounding only
                best = (gain[place], f, place, left_rows[place], left_sum[place])
        gain, feature, place, left_rows, left_sum = best
        if feature < 0:
            continue
        any_split = True
        tree.feature[node], tree.at[node], tree.gain[node] = feature, place, gain
        for child, n, s in ((2 * node + 1, left_rows, left_sum), (2 * node + 2, count - left_rows, total - left_sum)):
            tree.stats[child, :2] = n, s
            tree.value[child] = s / n
    return any_split


# Scoring of shuffled rows ----------------------------------------------------------------------


@dataclass
class LinearTerms:
    """A linear model: a prediction is a sum of one term per feature."""

    layout: Layout
    coefficients: np.ndarray
    intercept: float
    slope: float | None  # of the logistic curve; None for a plain prediction

    def trials(self, columns: list[np.ndarray], moves: list[tuple[int, int]]) -> Iterator[np.ndarray]:
        """The margin of every row, for each (feature, places) with the feature's values from so many rows further on."""
        starts = [*self.layout.starts(), len(self.coefficients)]
        terms = []
        for f, column in enumerate(columns):
            weights = self.coefficients[starts[f] : starts[f + 1]]
            terms.append(column * weights[0] if f < len(self.layout.numbers) else np.append(weights, 0.0)[column])
        for feature, places in moves:
            total = np.zeros(len(columns[0]))
            for f, term in enumerate(terms):
                total += np.roll(term, -places) if f == feature else term
            yield total + self.intercept


@dataclass
class BoostedTerms:
    """Boosted trees: a prediction is a weighted sum of what trees say."""

    layout: Layout
    trees: list[Tree]
    weights: list[float]
    slope: float | None

    def trials(self, columns: list[np.ndarray], moves: list[tuple[int, int]]) -> Iterator[np.ndarray]:
        """Like `LinearTerms.trials`. A tree is asked once for all features that it has no part in."""
        rows, n_numbers = len(columns[0]), len(self.layout.numbers)
        margins = np.zeros((len(moves), rows))
        for tree, weight in zip(self.trees, self.weights):
            nodes = np.flatnonzero(tree.feature >= 0)
            rights = {node: tree.goes_right(node, columns[tree.feature[node]], n_numbers) for node in nodes}
            said = weight * tree.value[tree.ends()]
            asked = set(tree.feature[nodes])
            plain = said[tree.turns(rights.__getitem__, rows)]
            for trial, (feature, places) in enumerate(moves):
                if feature not in asked:
                    margins[trial] += plain
                    continue
                # A turn follows from one value, so it moves as the value does.
                moved = {n: np.roll(right, -places) if tree.feature[n] == feature else right for n, right in rights.items()}
                margins[trial] += said[tree.turns(moved.__getitem__, rows)]
        yield from margins


def block_sums(
    batches: Iterator[pa.RecordBatch], terms: LinearTerms | BoostedTerms, target: str, moves: list[tuple[str, int]]
) -> Iterator[pa.RecordBatch]:
    """Per block and trial the rows and the sum of their scores: hits of a class, squared errors of a delay.

    Rows come block by block in the order of their tickets. `moves` are (feature, places), ('', 0) for none.
    """
    names = [*terms.layout.numbers, *terms.layout.slots]
    places = [(names.index(feature) if feature else -1, n) for feature, n in moves]

    def sums(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        y = rows.column(target).to_numpy(zero_copy_only=False).astype(np.float64)
        known = ~np.isnan(y)
        scores = []
        for margin in terms.trials(terms.layout.arrays(rows), [(f, n % len(y)) for f, n in places]):
            if terms.slope is None:
                score = (y - margin) ** 2
            else:
                with np.errstate(over="ignore"):
                    score = (1.0 / (1.0 + np.exp(-terms.slope * margin)) >= 0.5) == y
            scores.append(float(score[known].sum()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([feature for feature, _ in moves], pa.string()),
                pa.array([n for _, n in moves], pa.int32()),
                pa.array([int(known.sum())] * len(moves), pa.int64()),
                pa.array(scores, pa.float64()),
            ],
            names=["feature", "places", "rows", "score"],
        )

    held, block = [], None
    for batch in batches:
        named = batch.column("block")
        runs = pc.run_end_encode(named) if batch.num_rows else None
        start = 0
        for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()) if runs else ():
            if held and name != block:
                yield sums(held)
                held = []
            held.append(batch.slice(start, end - start))
            start, block = end, name
    if held:
        yield sums(held)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
