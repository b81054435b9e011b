"""Gradient-boosted trees on packed rows.

The trees are the ones Spark ML grows for ``GBTClassifier``: logistic loss on
labels -1 and 1, the first tree fitted to the labels and counted whole, each
further one to the negative gradients and counted with the step size; splits by
variance, at most ``maxBins`` bins a slot, values of a nominal slot sorted by
their mean; with an indicator column, boosting ends where the mean loss on the
marked rows rises, and the trees up to the smallest loss are kept. The result is
a ``GBTClassificationModel``.

Spark ML keeps an object with an integer per slot for each row and visits it once
per level and slot. Here the bins of several slots make up one code of two bytes,
and codes lie in blocks of many rows, so a row takes some twenty bytes and a level
counts codes with a few array operations per block. A level is one job: rows walk
down the tree as it stands, only the smaller child of each split is counted, and
its sibling is the parent less that. What comes back holds two numbers per node and
bin, whatever the number of rows, and is added up in steps where there are many
parts. The margins are kept with the rows and replaced once per tree.

Gradients are rounded to multiples of a power of two, so fine that their sums over
all rows are exact in 53 bits (2^-25 of a gradient at 2^25 rows). Sums, and with
them the trees, are then the same in any order and at any partitioning, and a
difference of two sums carries no error.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.session import scratch_folder

# what tasks run goes to them with its code: the library need not be on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of one block: its arrays are long beside what one array operation costs.
BLOCK_ROWS = 1 << 18

#: Rows of one block as it is stored: short enough to be dealt out evenly.
_PACKED_ROWS = 1 << 14

#: Bytes of one block, which bound its rows where there are very many slots.
_BLOCK_BYTES = 16 << 20

#: Bytes of the histograms of one task: nodes beyond that are left to another job.
_HISTOGRAM_BYTES = 64 << 20

#: Bins of several slots share a code while it has at most so many values.
CODE_VALUES = 1024

#: Parts whose histograms meet in the driver at once; more are added up in steps.
_DIRECT_PARTS = 32

#: Levels of a tree that rows pass at once: their nodes are the bits of one number.
_AT_ONCE = 6

#: Rows that walk down a tree at once: what they need on the way stays in the cache.
_STRIP_ROWS = 1 << 14

#: A gain below this share of the two sides' terms is rounding.
_ROUNDING = 1e-12


# ---- bins --------------------------------------------------------------------------


def nominal_values(vectors: DataFrame, column: str) -> dict[int, int]:
    """Number of values of each nominal slot, from the column's attributes."""
    attributes = vectors.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: 2 for a in attributes.get("binary", ())}
    for a in attributes.get("nominal", ()):
        found[a["idx"]] = a["num_vals"] if "num_vals" in a else len(a["vals"])
    return found


def sampled_rows(bins: int) -> int:
    """Rows from which Spark ML takes the limits of numeric slots."""
    return max(bins * bins, 10_000)


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Limits between at most ``bins`` bins of a numeric slot: all midpoints of its
    distinct values if they suffice, otherwise steps of equal weight."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = len(values) / bins
    kept, before, target = [], counts[0], stride
    for i in range(1, len(distinct)):
        after = before + counts[i]
        if abs(before - target) < abs(after - target):
            kept.append(middles[i - 1])
            target += stride
        before = after
    return np.array(kept)


@dataclass(frozen=True)
class Layout:
    """Where the bins of a slot lie: in which code, and in which place of it."""

    limits: tuple[np.ndarray | None, ...]  # None for a nominal slot
    bins: tuple[int, ...]
    group: tuple[int, ...]
    stride: tuple[int, ...]
    sizes: tuple[int, ...]  # values of each code

    @property
    def starts(self) -> np.ndarray:
        """Where the bins of each slot begin in a histogram, and where the last end."""
        return np.concatenate([[0], np.cumsum(self.bins)])

    def pack(self, values: np.ndarray) -> np.ndarray:
        """Codes (one row per group) of rows of slot values."""
        kind = np.uint16 if max(self.sizes) <= 1 << 16 else np.uint32
        codes = np.zeros((len(self.sizes), len(values)), kind)
        for slot, limits in enumerate(self.limits):
            column = np.ascontiguousarray(values[:, slot])
            if limits is None:
                bins = column.astype(np.int64)
                if len(bins) and not (0 <= bins.min() and bins.max() < self.bins[slot]):
                    raise ValueError(f"slot {slot} has values beyond its {self.bins[slot]}")
            else:
                bins = np.searchsorted(limits, column, side="left")
            codes[self.group[slot]] += (bins * self.stride[slot]).astype(kind)
        return codes

    @property
    def most_rows(self) -> int:
        """Rows of a block: codes, label and margin of each."""
        kind = 2 if max(self.sizes) <= 1 << 16 else 4
        return max(1, min(BLOCK_ROWS, _BLOCK_BYTES // (kind * len(self.sizes) + 9)))

    @property
    def most_nodes(self) -> int:
        """Nodes that one job counts."""
        return max(1, _HISTOGRAM_BYTES // (16 * max(sum(self.sizes), int(self.starts[-1]))))

    def bin_of(self, slot: int) -> np.ndarray:
        """The slot's bin for each value of its code."""
        code = np.arange(self.sizes[self.group[slot]])
        return code // self.stride[slot] % self.bins[slot]

    def spread(self, counted: list[np.ndarray]) -> np.ndarray:
        """Histograms of slots (nodes x bins of all slots) from those of codes."""
        out = np.zeros((len(counted[0]), int(self.starts[-1])))
        starts = self.starts
        for slot, (group, stride, bins) in enumerate(zip(self.group, self.stride, self.bins)):
            by_place = counted[group].reshape(len(out), -1, bins, stride)
            out[:, starts[slot] : starts[slot + 1]] = by_place.sum(axis=(1, 3))
        return out


def layout(limits: Iterable[np.ndarray | None], nominal: dict[int, int]) -> Layout:
    """Slots with the most bins first, each into the first code that has room."""
    limits = tuple(limits)
    bins = tuple(nominal[i] if v is None else len(v) + 1 for i, v in enumerate(limits))
    group, stride, sizes = [0] * len(bins), [1] * len(bins), []
    for slot in sorted(range(len(bins)), key=lambda i: -bins[i]):
        room = (g for g, size in enumerate(sizes) if size * bins[slot] <= CODE_VALUES)
        g = next(room, len(sizes))
        if g == len(sizes):
            sizes.append(1)
        group[slot], stride[slot] = g, sizes[g]
        sizes[g] *= bins[slot]
    return Layout(limits, bins, tuple(group), tuple(stride), tuple(sizes))


# ---- one tree --------------------------------------------------------------------


class Tree:
    """A tree while it grows: nodes by number, children after their parents."""

    def __init__(self, rows: float, total: float) -> None:
        self.rows, self.total = [rows], [total]
        self.level = [0]
        self.slot, self.goes_left, self.gain = [-1], [None], [-1.0]
        self.left, self.right = [-1], [-1]

    def __len__(self) -> int:
        return len(self.rows)

    def split(self, node: int, slot: int, goes_left: np.ndarray, gain: float, rows: float, total: float) -> None:
        """Split ``node`` by bins of ``slot``; ``rows`` and ``total`` are the left child's."""
        self.slot[node], self.goes_left[node], self.gain[node] = slot, goes_left, gain
        self.left[node], self.right[node] = len(self), len(self) + 1
        for r, t in ((rows, total), (self.rows[node] - rows, self.total[node] - total)):
            self.rows.append(r)
            self.total.append(t)
            self.level.append(self.level[node] + 1)
            self.slot.append(-1)
            self.goes_left.append(None)
            self.gain.append(-1.0)
            self.left.append(-1)
            self.right.append(-1)

    def smaller(self, node: int) -> int:
        left, right = self.left[node], self.right[node]
        return left if self.rows[left] <= self.rows[right] else right

    def walk(self, codes_of: Layout) -> Callable[[np.ndarray], np.ndarray]:
        """A function from codes to the nodes that rows reach.

        The first six levels are taken at once: a code's value rules out some of at
        most 64 nodes, and what no code rules out is where the row is. Below, a node
        has a table from the values of one code to the next node; a leaf leads to
        itself."""
        ends = [
            n
            for n, (level, slot) in enumerate(zip(self.level, self.slot))
            if level == _AT_ONCE or (level < _AT_ONCE and slot < 0)
        ]
        below = [0] * len(self)
        for place, node in enumerate(ends):
            below[node] = 1 << place
        masks: dict[int, np.ndarray] = {}
        whole = (1 << len(ends)) - 1
        for node in reversed(range(len(self))):
            if self.level[node] >= _AT_ONCE or self.slot[node] < 0:
                continue
            left, right = below[self.left[node]], below[self.right[node]]
            below[node] = left | right
            group, goes_left = self._of_code(node, codes_of)
            mask = masks.setdefault(group, np.full(len(goes_left), whole, np.uint64))
            mask &= np.where(goes_left, np.uint64(whole & ~right), np.uint64(whole & ~left))

        steps = max(0, max(self.level) - _AT_ONCE)
        groups, bases, tables, size = [], [], [np.zeros(0, np.int64)], 0
        small = int(np.argmin(codes_of.sizes))
        for node, (level, slot) in enumerate(zip(self.level, self.slot)):
            if steps and slot < 0 and level < _AT_ONCE + steps:
                group, table = small, np.full(codes_of.sizes[small], node)
            elif steps and slot >= 0 and level >= _AT_ONCE:
                group, goes_left = self._of_code(node, codes_of)
                table = np.where(goes_left, self.left[node], self.right[node])
            else:
                group, table = 0, tables[0]
            groups.append(group)
            bases.append(size)
            tables.append(table)
            size += len(table)
        kind = np.uint16 if len(self) <= 1 << 16 else np.uint32
        group, base = np.array(groups), np.array(bases)
        table, end = np.concatenate(tables).astype(kind), np.array(ends, kind)

        def strip(codes: np.ndarray) -> np.ndarray:
            left = None
            for g, mask in masks.items():
                found = mask.take(codes[g])
                left = found if left is None else np.bitwise_and(left, found, out=left)
            # the place of the one bit left is the exponent of the number
            place = left.astype(np.float64).view(np.int64)
            place >>= 52
            place -= 1023
            node = end.take(place)
            if steps:
                flat, rows = codes.reshape(-1), codes.shape[1]
                places, offsets = np.arange(rows), group * rows
            for _ in range(steps):
                at = offsets.take(node)
                at += places
                key = base.take(node)
                key += flat.take(at)
                node = table.take(key)
            return node

        def reached(codes: np.ndarray) -> np.ndarray:
            out = np.zeros(codes.shape[1], kind)
            if masks:
                for i in range(0, len(out), _STRIP_ROWS):
                    out[i : i + _STRIP_ROWS] = strip(codes[:, i : i + _STRIP_ROWS])
            return out

        return reached

    def _of_code(self, node: int, codes_of: Layout) -> tuple[int, np.ndarray]:
        """The code that decides at a node, and which of its values go left."""
        slot = self.slot[node]
        return codes_of.group[slot], self.goes_left[node][codes_of.bin_of(slot)]


@dataclass(frozen=True)
class _Class:
    """Slots of one kind with equally many bins, whose splits are sought together."""

    nominal: bool
    slots: np.ndarray
    places: np.ndarray  # slots x bins, in a histogram


def _classes(codes_of: Layout) -> list[_Class]:
    found: dict[tuple[bool, int], list[int]] = {}
    for slot, (limits, bins) in enumerate(zip(codes_of.limits, codes_of.bins)):
        if bins > 1:
            found.setdefault((limits is None, bins), []).append(slot)
    starts = codes_of.starts
    return [
        _Class(nominal, np.array(slots), starts[slots][:, None] + np.arange(bins))
        for (nominal, bins), slots in found.items()
    ]


def _best_splits(
    counts: np.ndarray, sums: np.ndarray, rows: np.ndarray, totals: np.ndarray, classes: list[_Class], n_slots: int
) -> list[tuple | None]:
    """For each node (a row of the histograms) its best split: slot, bins that go
    left, gain, and the left side's rows and total; None where nothing is gained.
    Among equal gains the first slot and the first limit win."""
    whole = totals**2 / rows
    gains = np.full((len(rows), n_slots), -np.inf)
    chosen: dict[int, tuple] = {}
    for kind in classes:
        n, s = counts[:, kind.places], sums[:, kind.places]
        order = None
        if kind.nominal:
            mean = np.divide(s, n, out=np.full(s.shape, np.inf), where=n > 0)
            order = np.argsort(mean, axis=2, kind="stable")
            n, s = np.take_along_axis(n, order, 2), np.take_along_axis(s, order, 2)
        n, s = n.cumsum(axis=2)[:, :, :-1], s.cumsum(axis=2)[:, :, :-1]
        rest_n, rest_s = rows[:, None, None] - n, totals[:, None, None] - s
        both = (n > 0) & (rest_n > 0)
        parts = np.divide(s * s, n, out=np.zeros(s.shape), where=both)
        parts += np.divide(rest_s * rest_s, rest_n, out=np.zeros(s.shape), where=both)
        gain = parts - whole[:, None, None]
        gain[~both | (gain <= _ROUNDING * parts)] = -np.inf
        cut = gain.argmax(axis=2)
        gains[:, kind.slots] = np.take_along_axis(gain, cut[:, :, None], 2)[:, :, 0]
        for i, slot in enumerate(kind.slots):
            chosen[int(slot)] = (kind, i, cut, order, n, s)
    best = gains.argmax(axis=1)
    found: list[tuple | None] = []
    for node, slot in enumerate(best):
        gain = gains[node, slot]
        if not gain > 0:
            found.append(None)
            continue
        kind, i, cut, order, n, s = chosen[int(slot)]
        k = cut[node, i]
        goes_left = np.arange(kind.places.shape[1]) <= k
        if order is not None:
            sorted_first, goes_left = goes_left, np.zeros_like(goes_left)
            goes_left[order[node, i][sorted_first]] = True
        found.append((int(slot), goes_left, float(gain), float(n[node, i, k]), float(s[node, i, k])))
    return found


# ---- rows ----------------------------------------------------------------------------


#: Rows to learn from, rows held out (of each: codes, labels of -1 and 1, margins), and
#: the sums of squared gradients per node of the last tree.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray]
Block = tuple[Rows, Rows, np.ndarray]


def _packed(
    vectors: DataFrame, features: str, label: str, held: str | None, codes_of: Layout, block_rows: int
) -> DataFrame:
    """The rows of ``vectors`` as blocks, with the number of rows to learn from."""
    rows = vectors.select(
        vector_to_array(features).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(held) if held else F.lit(False)).alias("held"),
    )

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            codes, labels, marked = (np.concatenate(p, axis=-1) for p in zip(*parts))
            sides = tuple((codes[:, m], labels[m], np.zeros(m.sum())) for m in (~marked, marked))
            data = pickle.dumps((*sides, np.zeros(1)), protocol=pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_pydict(
                {"n": pa.array([len(sides[0][1])], pa.int64()), "body": pa.array([data], pa.binary())}
            )

        parts, kept = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            codes = codes_of.pack(values.reshape(batch.num_rows, -1))
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isin(labels, (0.0, 1.0)).all():
                raise ValueError("there are labels that are neither 0 nor 1")
            marked = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            parts.append((codes, (2 * labels - 1).astype(np.int8), marked))
            kept += batch.num_rows
            if kept >= block_rows:
                yield block()
                parts, kept = [], 0
        if parts:
            yield block()

    return rows.mapInArrow(blocks, "n long, body binary")


def _dealt(stored: DataFrame, parts: int, block_rows: int) -> RDD:
    """Stored blocks in parts of about equally many rows, joined to long blocks."""

    def numbered(part: int, rows: Iterable) -> Iterator[tuple[int, bytes]]:
        return ((part + i, row[0]) for i, row in enumerate(rows))

    def joined(bodies: Iterable[tuple[int, bytes]]) -> Iterator[Block]:
        def block() -> Block:
            sides = tuple(
                tuple(np.concatenate([b[side][k] for b in found], axis=-1) for k in range(3))
                for side in range(2)
            )
            return (*sides, np.zeros(1))

        found, kept = [], 0
        for _, body in bodies:
            found.append(pickle.loads(body))
            kept += sum(len(side[1]) for side in found[-1][:2])
            if kept >= block_rows:
                yield block()
                found, kept = [], 0
        if found:
            yield block()

    keyed = stored.select("body").rdd.mapPartitionsWithIndex(numbered)
    return keyed.partitionBy(parts, lambda number: number).mapPartitions(joined)


def _targets(labels: np.ndarray, margins: np.ndarray | None, scale: float) -> np.ndarray:
    """What a tree is fitted to, in whole multiples of ``1 / scale``: labels at first,
    then negative gradients of the loss."""
    if margins is None:
        return labels * scale
    falls = np.exp(2.0 * labels * margins)
    falls += 1.0
    return np.rint((4.0 * scale) * labels / falls)


def _loss(labels: np.ndarray, margins: np.ndarray) -> float:
    return float(2.0 * np.logaddexp(0.0, -2.0 * labels * margins).sum())


def _counting(
    codes_of: Layout, tree: Tree | None, nodes: list[int], first: bool, scale: float
) -> Callable[[Iterable[Block]], Iterator[np.ndarray]]:
    """Histograms (rows, then totals) of the given nodes over one part. Without a
    tree all rows are in one node."""
    reached = None if tree is None else tree.walk(codes_of)
    numbers = np.full(1 if tree is None else len(tree), -1, np.int32)
    numbers[nodes] = np.arange(len(nodes))

    def run(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
        counts = [np.zeros(len(nodes) * size) for size in codes_of.sizes]
        sums = [np.zeros(len(nodes) * size) for size in codes_of.sizes]
        for (codes, labels, margins), *_ in blocks:
            rows = slice(None)
            number = np.zeros(len(labels), np.int64)
            if reached is not None:
                number = numbers.take(reached(codes))
                rows = np.flatnonzero(number >= 0)
                number = number.take(rows).astype(np.int64)
            target = _targets(labels[rows], None if first else margins[rows], scale)
            for k, size in enumerate(codes_of.sizes):
                key = number * size
                key += codes[k][rows]
                counts[k] += np.bincount(key, minlength=len(counts[k]))
                sums[k] += np.bincount(key, target, len(sums[k]))
        yield np.stack(
            [codes_of.spread([a.reshape(len(nodes), -1) for a in arrays]) for arrays in (counts, sums)]
        )

    return run


def _beginning(codes_of: Layout, first: bool, scale: float, n_squares: int) -> Callable:
    """Histogram of the root, then sums over the blocks: loss and number of the rows
    held out, squared gradients per node of the tree before."""
    count = _counting(codes_of, None, [0], first, scale)

    def run(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
        more = np.zeros(2 + n_squares)

        def seen() -> Iterator[Block]:
            for block in blocks:
                _, (_, labels, margins), squares = block
                more[0] += _loss(labels, margins)
                more[1] += len(labels)
                more[2:] += squares[:n_squares]
                yield block

        for histogram in count(seen()):
            yield np.concatenate([histogram.ravel(), more])

    return run


def _advancing(codes_of: Layout, tree: Tree, weight: float, first: bool, scale: float) -> Callable[[Block], Block]:
    """The block with the tree's predictions added to its margins."""
    reached = tree.walk(codes_of)
    values = weight * np.array(tree.total) / np.array(tree.rows) / scale

    def run(block: Block) -> Block:
        (codes, labels, margins), (held_codes, held_labels, held_margins), _ = block
        node = reached(codes)
        target = _targets(labels, None if first else margins, scale) / scale
        return (
            (codes, labels, margins + values.take(node)),
            (held_codes, held_labels, held_margins + values.take(reached(held_codes))),
            np.bincount(node, target * target, len(values)),
        )

    return run


def _added(parts: RDD) -> np.ndarray:
    """The sum over the parts, in steps where there are many of them."""
    return parts.treeReduce(np.add, 1 if parts.getNumPartitions() <= _DIRECT_PARTS else 2)


def _grown(blocks: RDD, root: np.ndarray, codes_of: Layout, depth: int, first: bool, scale: float) -> Tree:
    """One tree, level by level."""
    n_slots, classes = len(codes_of.bins), _classes(codes_of)
    end = codes_of.bins[0]
    tree = Tree(float(root[0, 0, :end].sum()), float(root[1, 0, :end].sum()))
    nodes, (counts, sums) = [0], root
    for level in range(depth):
        rows, totals = (np.array([a[n] for n in nodes]) for a in (tree.rows, tree.total))
        found = _best_splits(counts, sums, rows, totals, classes, n_slots)
        split = [i for i, best in enumerate(found) if best is not None]
        for i in split:
            slot, goes_left, gain, n, s = found[i]
            tree.split(nodes[i], slot, goes_left, gain, n, s)
        if not split or level + 1 == depth:
            break
        parents = [nodes[i] for i in split]
        smaller = [tree.smaller(p) for p in parents]
        most = codes_of.most_nodes
        part = np.concatenate(
            [
                _added(blocks.mapPartitions(_counting(codes_of, tree, smaller[i : i + most], first, scale)))
                for i in range(0, len(smaller), most)
            ],
            axis=1,
        )
        other = np.stack([counts[split], sums[split]]) - part
        larger = [tree.left[p] + tree.right[p] - s for p, s in zip(parents, smaller)]
        open_ = [i for i, node in enumerate(smaller + larger) if tree.rows[node] > 1]
        nodes = [(smaller + larger)[i] for i in open_]
        if not nodes:
            break
        counts, sums = np.concatenate([part, other], axis=1)[:, open_]
    return tree


# ---- boosting ---------------------------------------------------------------------


@dataclass(frozen=True)
class _Fitted:
    """A finished tree with the sums of squared gradients per node, for impurities."""

    tree: Tree
    squares: np.ndarray
    scale: float


def _squares(tree: Tree, of_leaves: np.ndarray) -> np.ndarray:
    """Sums per node from those of the leaves that rows ended in."""
    out = of_leaves.copy()
    for node in reversed(range(len(tree))):
        if tree.slot[node] >= 0:
            out[node] = out[tree.left[node]] + out[tree.right[node]]
    return out


def _forget(spark: SparkSession, checkpoint: str | None) -> None:
    if checkpoint:
        path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fit(
    booster: GBTClassifier,
    vectors: DataFrame,
    drawn: DataFrame | None = None,
    parts: Callable[[int, int], int] = lambda rows, cores: cores,
) -> GBTClassificationModel:
    """The model of the booster's parameters for the rows of ``vectors``.

    The limits of numeric slots come from the rows ``drawn`` of them, by default
    from as many as Spark ML takes. ``parts`` gives the number of parts for rows
    and cores; every level of every tree has one task for each.
    """
    spark = vectors.sparkSession
    features, label = booster.getFeaturesCol(), booster.getLabelCol()
    held = booster.getValidationIndicatorCol() if booster.isSet("validationIndicatorCol") else None
    nominal = nominal_values(vectors, features)
    most = booster.getMaxBins()
    if nominal and max(nominal.values()) > most:
        raise ValueError(f"a nominal slot has {max(nominal.values())} values, maxBins is {most}")
    if drawn is None:
        rows, wanted = vectors.count(), sampled_rows(most)
        drawn = vectors if rows <= wanted else vectors.sample(False, wanted / rows, booster.getSeed())
    if held:
        drawn = drawn.where(~F.col(held))
    sample = drawn.select(vector_to_array(features).alias("x")).toArrow().column("x").combine_chunks()
    if not len(sample):
        raise ValueError("no rows to learn from")
    values = sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1)
    bins = min(most, len(values))
    codes_of = layout(
        (None if i in nominal else split_points(values[:, i], bins) for i in range(values.shape[1])),
        nominal,
    )

    # stored, as an executor lost later would otherwise pack its rows in another order
    path, cores = scratch_folder(spark, "packed"), spark.sparkContext.defaultParallelism
    most_rows = codes_of.most_rows
    packed = _packed(vectors, features, label, held, codes_of, min(_PACKED_ROWS, most_rows))
    packed.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(packed.schema).parquet(path)
    n = stored.agg(F.sum("n")).first()[0]
    # sums of at most n numbers of at most 4 stay exact
    scale = 2.0 ** (50 - math.ceil(math.log2(n + 1)))
    # whole rounds of tasks
    rounds = math.ceil(parts(n, cores) / cores)
    blocks = _dealt(stored, rounds * cores, most_rows).persist(StorageLevel.MEMORY_AND_DISK)
    fitted, kept, best, saved = [], 0, math.inf, None
    shape = (2, 1, int(codes_of.starts[-1]))
    size = math.prod(shape)
    try:
        out = _added(blocks.mapPartitions(_beginning(codes_of, True, scale, 0)))
        while len(fitted) < booster.getMaxIter():
            first = not fitted
            tree = _grown(blocks, out[:size].reshape(shape), codes_of, booster.getMaxDepth(), first, scale)
            weight = 1.0 if first else booster.getStepSize()
            after = blocks.map(_advancing(codes_of, tree, weight, first, scale))
            after.persist(StorageLevel.MEMORY_AND_DISK)
            every = booster.getCheckpointInterval()
            due = every > 0 and (len(fitted) + 1) % every == 0
            if due:
                after.checkpoint()
            out = _added(after.mapPartitions(_beginning(codes_of, False, scale, len(tree))))
            blocks.unpersist()
            blocks = after
            if due:
                _forget(spark, saved)
                saved = after.getCheckpointFile()
            fitted.append(_Fitted(tree, _squares(tree, out[size + 2 :]), scale))
            if not held:
                kept = len(fitted)
                continue
            loss = out[size] / out[size + 1] if out[size + 1] else math.nan
            if first:
                best, kept = loss, 1
            elif best - loss < booster.getValidationTol() * max(loss, 0.01):
                break
            elif loss < best:
                best, kept = loss, len(fitted)
    finally:
        blocks.unpersist()
        _forget(spark, saved)
    return _model(spark, booster, fitted[:kept], codes_of)


# ---- the model in Spark ML's stored form ---------------------------------------------

_TREE_PARAMETERS = {
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins",
    "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode",
    "predictionCol", "seed",
}

_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
    "rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _metadata(spark: SparkSession, booster: GBTClassifier, kind: str, uid: str, names=None, **more) -> str:
    own, default = {}, {}
    for p in booster.params:
        if names is None or p.name in names:
            if booster.isSet(p):
                own[p.name] = booster.getOrDefault(p)
            elif booster.hasDefault(p):
                default[p.name] = booster.getOrDefault(p)
    about = {
        "class": f"org.apache.spark.ml.{kind}",
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "uid": uid,
        "paramMap": own,
        "defaultParamMap": default,
    }
    return json.dumps(about | more)


def _nodes(number: int, one: _Fitted, codes_of: Layout) -> Iterator[tuple]:
    tree, squares = one.tree, one.squares
    for node in range(len(tree)):
        rows, total = tree.rows[node], tree.total[node] / one.scale
        slot, gain, split = tree.slot[node], -1.0, (-1, [], -1)
        if slot >= 0:
            gain = tree.gain[node] / rows / one.scale**2
            left, limits = tree.goes_left[node], codes_of.limits[slot]
            if limits is None:
                split = (slot, [float(v) for v in np.flatnonzero(left)], codes_of.bins[slot])
            else:
                split = (slot, [float(limits[int(left.sum()) - 1])], -1)
        square = float(squares[node])
        impurity = max(0.0, square / rows - (total / rows) ** 2)
        stats = [rows, total, square]
        about = (node, total / rows, impurity, stats, int(rows), gain, tree.left[node], tree.right[node], split)
        yield number, about


def _model(spark: SparkSession, booster: GBTClassifier, fitted: list[_Fitted], codes_of: Layout) -> GBTClassificationModel:
    """Written in the form in which Spark ML stores such a model, and loaded."""
    path = scratch_folder(spark, "boosted")
    about = _metadata(
        *(spark, booster, "classification.GBTClassificationModel", booster.uid),
        numFeatures=len(codes_of.bins),
        numTrees=len(fitted),
    )
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = [
        (
            number,
            _metadata(
                *(spark, booster, "regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}"),
                names=_TREE_PARAMETERS,
            ),
            booster.getStepSize() if number else 1.0,
        )
        for number in range(len(fitted))
    ]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for number, one in enumerate(fitted) for row in _nodes(number, one, codes_of)]
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
