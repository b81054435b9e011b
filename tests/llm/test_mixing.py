import hashlib
import random
from collections import Counter

import pytest

from punctual.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, whole int"


def filled(sizes, weights, total, cap=2.0):
    """Water-filling by repeated clamping."""
    target = {s: 0.0 for s in sizes}
    free = {s for s in sizes if sizes[s]}
    rest = total
    while free:
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s] + 1e-9}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = cap * sizes[s]
            rest -= target[s]
        free -= over
    return target


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    names = ["b", "a", None, "Ä", "c", "tiny"]
    rows = []
    for i in range(n):
        source = names[min(5, int(rng.expovariate(0.9)))]
        rows.append((i, "w " * rng.randrange(40), source, "x", 1))
    return rows


def test_targets_and_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in mixing.mix_plan(df).collect()}
    sizes = Counter()
    for doc_id, text, source, *_ in rows:
        sizes[source] += len(text.split())
        assert got[doc_id].size == len(text.split())
    ordered = sorted((s for s in sizes if s is not None), key=str) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ordered)}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()))
    taken, largest = Counter(), Counter()
    for doc_id, text, source, *_ in rows:
        row = got[doc_id]
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(want[source])
        assert 0 <= row.taken <= 2 * row.size
        assert row.size == 0 or row.taken % row.size == 0
        taken[source] += row.taken
        largest[source] = max(largest[source], row.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source] / 2 + 1e-6


def test_reruns_and_partitions_agree(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    first = sorted(map(tuple, mixing.mix_plan(df).collect()))
    assert first == sorted(map(tuple, mixing.mix_plan(df.repartition(13)).collect()))


def test_documents_are_repeated_as_planned(spark):
    df = spark.createDataFrame(corpus(200), SCHEMA)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    for r in mixing.mix_plan(df).collect():
        assert copies[r.doc_id] * r.size == r.taken


def test_edges(spark):
    rows = [
        (1, None, "a", None, None),
        (2, "", None, None, None),
        (None, "one two", "b", None, None),
        (3, "x y z", "b", None, None),
        (3, "x y z", "b", None, None),
        (3, "other text", "b", None, None),
        (4, "w " * 50_000, "c", None, None),
    ]
    got = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix_plan(spark.createDataFrame(rows[:2], SCHEMA)).count() == 2
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    plan = mixing.mix_plan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_no_document_exceeds_the_most_epochs(spark):
    # sources at their cap take every document twice, empty ones included
    rows = [(i, "" if i % 3 else "a b c", "only", "", 0) for i in range(60)]
    mix = mixing.Mix(total_share=2.0)
    got = Counter(r.doc_id for r in mixing.mix_documents(spark.createDataFrame(rows, SCHEMA), mix).collect())
    assert got == {i: 2 for i in range(60)}


def test_rows_of_one_id_are_not_one_block(spark):
    rows = [(None if i % 3 else i, f"word{i} " * 10, "one", "", 0) for i in range(300)]
    mix = mixing.Mix(total_share=0.5)
    df = spark.createDataFrame(rows, SCHEMA)
    assert abs(sum(r.taken for r in mixing.mix_plan(df, mix).collect()) - 1500) <= 5
    assert mixing.mix_documents(df, mix).count() == 150


def test_equal_rows_are_divided(spark):
    # a third of the rows agree in all columns, and the prefix ends in their middle
    rows = [(None, "a b c", "one", "", 0)] * 100 + [(i, "a b c", "one", "", 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    place = hashlib.md5(b"11:").hexdigest()
    ahead = sum(hashlib.md5(f"11:{i}".encode()).hexdigest() < place for i in range(200))
    mix = mixing.Mix(total_share=1 + (ahead + 50) / 300)
    taken = [r.taken for r in mixing.mix_plan(df, mix).collect()]
    assert Counter(taken) == {6: ahead + 50, 3: 250 - ahead}
    copies = Counter(r.doc_id for r in mixing.mix_documents(df, mix).collect())
    assert copies[None] == 150 and copies.total() == 350 + ahead


def test_a_hot_place_of_the_order_is_split(spark):
    # rows without id fall into one bucket; ranges by text share its rows out
    rows = [(None, f"word{i} " * 9, "one", "", 0) for i in range(3000)]
    mix = mixing.Mix(total_share=0.5)
    narrow = mixing._narrow(spark.createDataFrame(rows, SCHEMA), mix)
    inside = narrow.selectExpr(
        "source AS named", "'0' AS bucket", "0L AS before", "13500.0D AS rest", "*"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = inside.repartitionByRange("named", "order_key", "row")
        sizes = Counter(r.p for r in dealt.selectExpr("spark_partition_id() AS p").collect())
        assert len(sizes) > 1 and max(sizes.values()) < 1500
        got = mixing._last_taken(inside).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 1 and got[0].n_last == got[0].n_equal == 1
    assert narrow.where(f"order_key <= '{got[0].last_key}'").count() == 1500
