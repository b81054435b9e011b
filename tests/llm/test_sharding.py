import random
import zlib
from collections import Counter

import pytest

from punctual.llm import sharding

SCHEMA = "doc_id long, text string, source string, shard string, place double"


def checked(rows, got, shards=8):
    assert len(got) == len(rows)
    texts = Counter((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == texts
    counts = Counter(r.shard for r in got)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in got)


def corpus(n, seed=1):
    rng = random.Random(seed)
    hot = ["hot", "b", None, "c", "d"]
    return [(i, "ä" * rng.randrange(9), hot[min(4, int(rng.expovariate(1)))], "", 0.0) for i in range(n)]


@pytest.mark.parametrize("n", [1, 7, 8, 1003])
def test_shards(spark, n):
    rows = corpus(n)
    checked(rows, sharding.shard_rows(spark.createDataFrame(rows, SCHEMA)).collect())


def test_every_shard_matches_the_mixture(spark):
    rows = corpus(2000)
    got = sharding.shard_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    source = {r[0]: r[2] for r in rows}
    total = Counter(source.values())
    for s in range(8):
        mine = Counter(source[r.doc_id] for r in got if r.shard == s)
        for name, n in total.items():
            assert abs(mine[name] - n / 8) <= 2


def test_order_inside_a_source_is_shuffled(spark):
    rows = [(i, "t", "one", "", 0.0) for i in range(400)]
    got = sharding.shard_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    again = sharding.shard_rows(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert order == [r.doc_id for r in sorted(again, key=lambda r: (r.shard, r.slot))]


def test_edges(spark):
    rows = [
        (1, None, None, "", None),
        (1, None, None, "", None),
        (None, "", "a", None, 1.0),
        (None, "x", "a", None, 1.0),
        (2, "long " * 40_000, "b", None, 1.0),
    ]
    checked(rows, sharding.shard_rows(spark.createDataFrame(rows, SCHEMA)).collect())
    assert sharding.shard_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_single_row_sources_spread(spark):
    rows = [(i, "t", f"s{i}", "", 0.0) for i in range(800)]
    got = sharding.place_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.position for r in got) == list(range(800))


def test_no_python_in_the_plan(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    plan = sharding.shard_rows(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_rows_without_id_are_spread(spark):
    rows = [(None if i % 3 else i, f"t{i}", "one", "", 0.0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    checked(rows, sharding.shard_rows(df).collect())
    keys = df.where("doc_id IS NULL").select(sharding._row_key(17).substr(1, 3).alias("k"))
    assert keys.distinct().count() > 400


def test_order_by_fractional_rank(spark):
    import hashlib

    rows = corpus(500)

    def md5(x):
        return hashlib.md5(x.encode()).hexdigest()

    def key(value):
        return md5(f"17:{'' if value is None else value}")

    by_source = {}
    for r in rows:
        by_source.setdefault(r[2], []).append((md5(key(r[0]) + md5(r[1] or "")), r[0]))
    placed = []
    for source, members in by_source.items():
        shift = int(key(source)[:8], 16) / 2**32
        for rank, (_, doc_id) in enumerate(sorted(members)):
            placed.append(((rank + shift) / len(members), doc_id))
    order = [d for _, d in sorted(placed)]
    got = sharding.shard_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] == order
    assert all(r.shard == i * 8 // len(rows) for i, r in enumerate(sorted(got, key=lambda r: (r.shard, r.slot))))
