"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Vectors are dealt over cells of space: a coarse tree of hyperplanes, fitted on a
bounded sample, says which cell a vector lies in, and every vector is dealt by
it. A cell is cut by a hash of the id into shards of bounded size, so that a
cell with a third of all vectors is many shards. In a shard they form a ball
tree; the inner product of a query with anything in a ball is at most
``query . centre + |query| * radius``. Queries go down together, each towards
the child with the higher bound first, and leave a ball out when its bound is
below their current k-th score. Every query is first answered in its own shard;
the k-th score found there travels with it to the others.

A cell is a ball as well: its centre is the mean of its part of the sample, its
radius the largest distance of any of its vectors, taken over all of them. A
query is sent to the shards of those cells whose bound reaches its k-th score,
the others are ruled out before the shuffle. The sample decides where vectors
lie, never what is found. Cells are ``CELLS`` at most; their balls are all that
passes through the driver. Vectors of another length than most have one more
cell, which is never ruled out for queries of such lengths.

A task holds one shard's vectors and streams the queries past them in Arrow
batches; per query at most k rows leave a shard.

Components become ``floor(256 * x)``; scores are integers, and float64 products
are exact for them below 2 ** 53. A shard whose products could be larger is
scored in 64-bit integers and not pruned.

Edge cases: NULL vectors and those with NULL or non-finite components take no
part; vectors of another length than the query's are no candidates; an empty
vector scores 0; equal scores rank by id; rows that repeat id and vector count
once, rows with one id and different vectors are queries and candidates of
their own, though never candidates for their own id; NULL ids take no part; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import stored

SHARD_ROWS = 16384
LEAF_ROWS = 128
#: Cells of the coarse tree, and the expected number of vectors it is fitted on.
CELLS = 1024
SAMPLE_ROWS = 16384
_LOWEST = np.iinfo(np.int64).min


@dataclass
class BallTree:
    """Nodes as arrays; the rows of a leaf are neighbours in ``order``."""

    rows: np.ndarray  # sorted by leaf, integer components
    ids: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    left: np.ndarray  # -1 for a leaf
    right: np.ndarray
    exact: bool

    @staticmethod
    def build(ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> BallTree:
        spread = rows.astype(np.float64)
        order = np.arange(len(rows))
        nodes: list[list] = []
        todo = [(0, len(rows), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            mine = spread[order[start:stop]]
            centre = mine.mean(axis=0)
            away = np.sqrt(((mine - centre) ** 2).sum(axis=1))
            number = len(nodes)
            nodes.append([centre, float(away.max()), start, stop, -1, -1])
            if parent >= 0:
                nodes[parent][4 + side] = number
            if stop - start > leaf_rows and away.max() > 0:
                # towards the farthest point from the centre, and from that one
                one = mine[away.argmax()]
                two = mine[((mine - one) ** 2).sum(axis=1).argmax()]
                along = mine @ (one - two)
                half = (stop - start) // 2
                order[start:stop] = order[start:stop][np.argpartition(along, half)]
                todo += [(start, start + half, number, 0), (start + half, stop, number, 1)]
        columns = list(zip(*nodes))
        most = float(np.abs(spread).max(initial=0))
        return BallTree(
            rows[order],
            ids[order],
            np.array(columns[0]).reshape(len(nodes), rows.shape[1]),
            *[np.array(c) for c in columns[1:]],
            exact=most * most * max(1, rows.shape[1]) < 2.0**53,
        )

    def search(
        self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best scores and ids per query, best first; missing ones have
        id -1. Scores below ``floor`` may be left out."""
        n = len(queries)
        scores = np.full((n, k), _LOWEST)
        ids = np.full((n, k), -1)
        kth = floor.copy()
        points = queries.astype(np.float64)
        length = np.sqrt((points**2).sum(axis=1))
        leaves = self.rows.astype(np.float64) if self.exact else self.rows
        sides = points if self.exact else queries

        def bound(node: int, who: np.ndarray) -> np.ndarray:
            if not self.exact:
                return np.full(len(who), np.inf)
            top = points[who] @ self.centres[node] + length[who] * self.radii[node]
            return top + 0.5 + 1e-9 * np.abs(top)

        everyone = np.arange(n)
        todo = [(0, everyone, bound(0, everyone))]
        while todo:
            node, who, top = todo.pop()
            can = top >= kth[who]
            who = who[can]
            if not len(who):
                continue
            a, b = self.left[node], self.right[node]
            if a >= 0:
                top_a, top_b = bound(a, who), bound(b, who)
                nearer = top_a >= top_b
                for child, first in ((b, nearer), (a, ~nearer), (b, ~nearer), (a, nearer)):
                    if first.any():
                        todo.append((child, who[first], (top_b if child == b else top_a)[first]))
                continue
            part = slice(self.starts[node], self.stops[node])
            found = (sides[who] @ leaves[part].T).astype(np.int64)
            found[self.ids[part][None, :] == own[who][:, None]] = _LOWEST
            better = (found >= kth[who][:, None]).any(axis=1)
            who, found = who[better], found[better]
            if not len(who):
                continue
            new = np.where(found > _LOWEST, self.ids[part][None, :], -1)
            all_scores = np.concatenate([scores[who], found], axis=1)
            all_ids = np.concatenate([ids[who], new], axis=1)
            best = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]  # ~ turns the order round
            scores[who] = np.take_along_axis(all_scores, best, axis=1)
            ids[who] = np.take_along_axis(all_ids, best, axis=1)
            last = scores[who, k - 1]
            kth[who] = np.maximum(kth[who], last)
        return scores, ids


def _matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.int64).reshape(len(column), length)


@dataclass
class Cells:
    """Cells of a binary space partition, for vectors of one length. Cell number
    ``len(centres)`` takes those of any other length."""

    length: int
    normals: np.ndarray
    cuts: np.ndarray
    below: np.ndarray  # a node, or ~cell
    above: np.ndarray
    centres: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, most: int) -> Cells:
        """At most ``most`` cells by cutting the largest part of the sample in halves."""
        rows = sample.astype(np.float64)
        length = rows.shape[1]
        nodes: list[list] = []  # normal, cut, below, above
        parts = [(-len(rows), 0, np.arange(len(rows)), -1, 0)]
        cells: list[tuple[np.ndarray, int, int]] = []
        made = 1
        while parts:
            _, _, mine, parent, side = heappop(parts)
            more = len(mine) > 1 and len(parts) + len(cells) + 1 < most
            halves = _halves(rows[mine]) if more else None
            if halves is None:
                cells.append((mine, parent, side))
                continue
            normal, cut, high = halves
            number = len(nodes)
            nodes.append([normal, cut, 0, 0])
            if parent >= 0:
                nodes[parent][2 + side] = number
            for into, which in enumerate((mine[~high], mine[high])):
                heappush(parts, (-len(which), made, which, number, into))
                made += 1
        for cell, (_, parent, side) in enumerate(cells):
            if parent >= 0:
                nodes[parent][2 + side] = ~cell
        empty = np.zeros(length)
        return Cells(
            length,
            np.array([n[0] for n in nodes]).reshape(len(nodes), length),
            np.array([n[1] for n in nodes], np.float64),
            np.array([n[2] for n in nodes], np.int64),
            np.array([n[3] for n in nodes], np.int64),
            np.stack([rows[c].mean(axis=0) if len(c) else empty for c, _, _ in cells]),
        )

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and its distance from that cell's centre."""
        points = rows.astype(np.float64)
        cell = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))] if len(self.cuts) else []
        while todo:
            node, who = todo.pop()
            high = points[who] @ self.normals[node] >= self.cuts[node]
            for into, part in ((self.below[node], who[~high]), (self.above[node], who[high])):
                if into < 0:
                    cell[part] = ~into
                elif len(part):
                    todo.append((int(into), part))
        away = np.empty(len(rows))
        for part in range(0, len(rows), 4096):
            near = slice(part, part + 4096)
            away[near] = np.sqrt(((points[near] - self.centres[cell[near]]) ** 2).sum(axis=1))
        return cell, away

    def reached(self, queries: np.ndarray, floor: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """Which cells may hold a score of at least ``floor``: queries by cells. A
        bound that is not safely exact rules nothing out."""
        points = queries.astype(np.float64)
        length = np.sqrt((points**2).sum(axis=1))
        far = length[:, None] * (np.sqrt((self.centres**2).sum(axis=1)) + radii)
        top = points @ self.centres.T + length[:, None] * radii + 0.5 + 1e-9 * far
        return (top >= floor[:, None].astype(np.float64)) | (far >= 2.0**53)


def _halves(rows: np.ndarray) -> tuple[np.ndarray, float, np.ndarray] | None:
    """A plane between two far points that halves the rows: normal, cut, who lies above."""
    centre = rows.mean(axis=0)
    one = rows[((rows - centre) ** 2).sum(axis=1).argmax()]
    two = rows[((rows - one) ** 2).sum(axis=1).argmax()]
    normal = one - two
    along = rows @ normal
    cut = np.median(along)
    if not (along < cut).any():
        more = along[along > cut]
        if not len(more):
            return None
        cut = more.min()
    high = along >= cut
    return normal, float(cut), high


def _by_length(vecs: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have that length, and those as a matrix."""
    import pyarrow.compute as pc

    usual = np.asarray(pc.list_value_length(vecs).to_numpy(zero_copy_only=False)) == length
    return usual, _matrix(pa.chunked_array([vecs.filter(pa.array(usual))]), length)


def _usual(vecs: pa.Array) -> np.ndarray:
    """The vectors of the most frequent length."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.list_value_length(vecs).to_numpy(zero_copy_only=False), np.int64)
    lengths, often = np.unique(sizes, return_counts=True)
    return _by_length(vecs, int(lengths[often.argmax()]) if len(lengths) else 0)[1]


def _placing(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usual, rows = _by_length(batch.column("vec"), cells.length)
            cell = np.full(batch.num_rows, len(cells.centres), np.int64)
            away = np.zeros(batch.num_rows)
            cell[usual], away[usual] = cells.place(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vec"), pa.array(cell), pa.array(away)],
                names=["vec_id", "vec", "cell", "away"],
            )

    return run


def _routing(cells: Cells, radii: np.ndarray, names: list[str]):
    """Add to each query the cells that it has to ask."""
    other = len(cells.centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usual, rows = _by_length(batch.column("vec"), cells.length)
            floor = np.asarray(batch.column("floor").fill_null(_LOWEST).to_numpy(), np.int64)
            can = np.zeros((batch.num_rows, other + 1), bool)
            can[usual, :other] = cells.reached(rows, floor[usual], radii)
            can[~usual, other] = True
            ends = np.concatenate([[0], np.cumsum(can.sum(axis=1))])
            reach = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.nonzero(can)[1], pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], reach], names=[*names, "reach"]
            )

    return run


def _searching(k: int, leaf_rows: int):
    """Answer a stream of shards, each with its vectors (kind 0) first, then queries."""

    def answers(trees: dict[int, BallTree], part: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = part.column("size").to_numpy()
        for length in np.unique(sizes):
            tree = trees.get(int(length))
            if tree is None:
                continue
            mine = part.filter(pa.array(sizes == length))
            own = mine.column("vec_id").to_numpy()
            marks = mine.column("mark").to_numpy()
            floor = np.asarray(mine.column("floor").fill_null(_LOWEST).to_numpy(), np.int64)
            scores, ids = tree.search(own, _matrix(mine.column("vec"), int(length)), floor, k)
            row, place = np.nonzero((ids != -1) | (scores > _LOWEST))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (own[row], marks[row], ids[row, place], scores[row, place])],
                names=["query_id", "mark", "vec_id", "score"],
            )

    def grown(vectors: list[pa.Table]) -> dict[int, BallTree]:
        whole = pa.concat_tables(vectors)
        sizes = whole.column("size").to_numpy()
        trees = {}
        for length in np.unique(sizes):
            mine = whole.filter(pa.array(sizes == length))
            ids, rows = mine.column("vec_id").to_numpy(), _matrix(mine.column("vec"), int(length))
            once = np.unique(np.column_stack([ids, rows]), axis=0)
            trees[int(length)] = BallTree.build(once[:, 0], once[:, 1:], leaf_rows)
        return trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, vectors, trees = None, [], None
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            shards, kinds = whole.column("shard").to_numpy(), whole.column("kind").to_numpy()
            turn = np.flatnonzero((shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            edges = [0, *turn.tolist(), len(shards)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part = whole.slice(a, b - a)
                if shards[a] != shard:
                    shard, vectors, trees = shards[a], [], None
                if kinds[a] == 0:
                    vectors.append(part)
                    continue
                if trees is None:
                    trees = grown(vectors) if vectors else {}
                    vectors = []
                yield from answers(trees, part)

    return run


_FOUND = "query_id long, mark long, vec_id long, score long"


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k best others for every vector whose ``vec_id`` is divisible by ``every``."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    known = vectors.where(
        F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & finite
    ).select(F.col("vec_id").cast("long"), whole.alias("vec"))
    rows = known.count()
    sample = known.select("vec").sample(min(1.0, SAMPLE_ROWS / max(1, rows)), seed=1).toArrow()
    cells = Cells.fit(
        _usual(sample.column("vec").combine_chunks()), min(CELLS, max(1, -(-rows // shard_rows)))
    )
    placed = stored(
        known.mapInArrow(_placing(cells), "vec_id long, vec array<long>, cell long, away double"),
        "topk-vectors",
    )
    # one row per cell: its radius and the shards it is cut into
    radii, pieces = np.zeros(len(cells.centres)), np.ones(len(cells.centres) + 1, np.int64)
    for row in placed.groupBy("cell").agg(F.max("away").alias("r"), F.count("*").alias("n")).collect():
        pieces[row.cell] = -(-row.n // shard_rows)
        if row.cell < len(radii):
            radii[row.cell] = row.r
    first = np.cumsum(pieces) - pieces

    def of_cell(numbers: np.ndarray, cell) -> Column:
        return F.get(F.lit([int(x) for x in numbers]).cast("array<bigint>"), cell.cast("int"))

    cell = F.col("cell")
    home = of_cell(first, cell) + F.pmod(F.xxhash64("vec_id"), of_cell(pieces, cell))
    held = placed.select(
        home.alias("shard"),
        F.lit(0).alias("kind"),
        "vec_id",
        F.lit(0).cast("long").alias("mark"),
        F.size("vec").cast("long").alias("size"),
        "vec",
        F.lit(None).cast("long").alias("floor"),
    )
    queries = placed.where(F.col("vec_id") % every == 0).select(
        home.alias("shard"),
        F.lit(1).alias("kind"),
        "vec_id",
        F.xxhash64("vec").alias("mark"),
        F.size("vec").cast("long").alias("size"),
        "vec",
    ).distinct()

    def answered(asked: DataFrame) -> DataFrame:
        rows = held.union(asked.select(held.columns))
        dealt = rows.repartition("shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(_searching(k, leaf_rows), _FOUND)

    at_home = stored(
        answered(queries.withColumn("floor", F.lit(None).cast("long"))), "topk-home"
    )
    found = at_home
    if pieces.sum() > 1:
        kth = (
            at_home.groupBy("query_id", "mark")
            .agg(F.min("score").alias("least"), F.count("*").alias("n"))
            .select(
                "query_id",
                F.col("mark").alias("of"),
                F.when(F.col("n") >= k, F.col("least")).alias("floor"),
            )
        )
        asked = queries.join(
            kth, (F.col("vec_id") == F.col("query_id")) & (F.col("mark") == F.col("of")), "left"
        ).select(held.columns)
        routed = asked.mapInArrow(
            _routing(cells, radii, held.columns),
            T.StructType([*asked.schema.fields, T.StructField("reach", T.ArrayType(T.LongType()))]),
        )
        shards = F.flatten(
            F.transform(
                "reach",
                lambda c: F.sequence(of_cell(first, c), of_cell(first + pieces - 1, c)),
            )
        )
        others = F.filter(shards, lambda s: s != F.col("shard"))
        found = found.union(answered(routed.withColumn("shard", F.explode(others))))
    ranking = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
