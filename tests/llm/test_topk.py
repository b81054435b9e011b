import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=5, every=50):
    known = {}
    for vec_id, vec, _ in rows:
        if vec_id is None or vec is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vec):
            continue
        known[(vec_id, tuple(math.floor(256 * float(np.float32(x))) for x in vec))] = None
    out = []
    for query, q in known:
        if query % every:
            continue
        found = [
            (-sum(a * b for a, b in zip(q, v)), other)
            for other, v in known
            if other != query and len(v) == len(q)
        ]
        out += [(query, i + 1, o, -s) for i, (s, o) in enumerate(sorted(found)[:k])]
    return sorted(out)


def answers(spark, rows, **knobs):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, **knobs).collect())


@pytest.mark.parametrize("shard_rows, leaf_rows", [(64, 8), (10_000, 16)])
def test_equals_brute_force(spark, shard_rows, leaf_rows):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 6).astype(np.float32).tolist(), "x") for i in range(400)]
    got = answers(spark, rows, shard_rows=shard_rows, leaf_rows=leaf_rows)
    assert got == brute(rows)


def test_edges(spark):
    rows = [
        (0, [1.0, 2.0], "a"),
        (0, [1.0, 2.0], "a"),  # a repeated row counts once
        (50, [1.0, 2.0], None),
        (1, [1.0, 2.0], "b"),
        (2, [1.0, 2.0], "b"),  # a tie: the smaller id first
        (3, [1.0, None], "c"),
        (4, [float("nan"), 1.0], "c"),
        (5, [float("inf"), 1.0], "c"),
        (6, None, "c"),
        (None, [1.0, 1.0], "c"),
        (7, [1.0], "other length"),
        (100, [], "empty"),
        (101, [], "empty"),
        (-1, [-1.0, -1.0], "negative id"),
    ]
    got = answers(spark, rows)
    assert got == brute(rows)
    assert (100, 1, 101, 0) in got


def test_empty_table(spark):
    assert answers(spark, []) == []


def test_own_id_never_answers_and_large_scores_are_exact(spark):
    rows = [(50, [3e6, 1.0], ""), (50, [2e6, 1.0], ""), (1, [2.5e6, 7.0], ""), (2, [2.5e6, 8.0], "")]
    assert answers(spark, rows) == brute(rows)


def test_plan_reads_only_needed_columns(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    assert topk.top_k(df).where(F.col("rank") == 1).count() == df.where("vec_id % 50 = 0").count()


def clustered(rng, n, width=8, places=12):
    middles = rng.normal(0, 4, (places, width))
    near = middles[rng.integers(0, places, n)] + rng.normal(0, 0.2, (n, width))
    return [(i, v.astype(np.float32).tolist(), "x") for i, v in enumerate(near)]


def test_clusters_a_hot_vector_and_two_lengths(spark):
    rng = np.random.default_rng(8)
    rows = clustered(rng, 500)
    rows += [(1000 + i, [1.5] * 8, "hot") for i in range(250)]  # one cell, cut into shards
    rows += [(2000 + i, rng.normal(0, 1, 3).tolist(), "short") for i in range(150)]
    assert answers(spark, rows, shard_rows=32, leaf_rows=8) == brute(rows)


def test_cells_hold_all_rows_and_rule_out_only_what_is_worse():
    rng = np.random.default_rng(9)
    rows = np.array([r[1] for r in clustered(rng, 3000)])
    rows = np.floor(rows * 256).astype(np.int64)
    cells = topk.Cells.fit(rows[::5], 16)
    place, away = cells.place(rows)
    assert len(cells.centres) == 16 and set(place) == set(range(16))
    radii = np.array([away[place == c].max() for c in range(16)])
    queries = rows[::50]
    scores = queries @ rows.T
    floor = np.sort(scores, axis=1)[:, -6]
    can = cells.reached(queries, floor, radii)
    for c in range(16):
        best = scores[:, place == c].max(axis=1)
        assert can[best >= floor, c].all()
    assert can.mean() < 0.5


def test_cells_of_equal_empty_and_few_rows():
    same = topk.Cells.fit(np.ones((50, 3)), 8)
    assert len(same.centres) == 1 and same.place(np.ones((2, 3), np.int64))[0].tolist() == [0, 0]
    none = topk.Cells.fit(np.zeros((0, 0)), 8)
    assert none.length == 0 and len(none.centres) == 1
    assert len(topk.Cells.fit(np.zeros((3, 0)), 4).centres) == 1
    mostly = topk.Cells.fit(np.concatenate([np.zeros((30, 2)), np.ones((1, 2))]), 4)
    assert len(mostly.centres) == 2
