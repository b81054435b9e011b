"""Registered queries against their SQL, and the pipeline's stages in order."""

import hashlib
import sys
from collections import Counter
from pathlib import Path

import compare
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
import test_mixing
import test_quality
import test_simhash
from punctual.llm.oracle import oracle_sql
from punctual.llm.queries import queries


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, small, con, name):
    df, sql = queries()[name](spark, small), oracle_sql()[name]
    assert compare.kinds(df, con, sql) == {}
    assert compare.spark_rows(df) == compare.sql_rows(con, sql)


def test_all_operators_and_the_pipeline():
    import __spark_entry__

    names = [n.split("_")[0] for n in queries()]
    assert sorted(names) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
    assert set(queries()) <= set(__spark_entry__.queries())
    assert set(oracle_sql()) <= set(__spark_entry__.oracle_sql())


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, small)
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= ids
        ids = {r.doc_id for r in rows}
        if number < 4:
            assert docs.columns == columns
        if name in ("quality", "near_copies"):
            assert len(rows) == len(ids)
        docs = spark.createDataFrame(rows, docs.schema)
    assert all(r.n_tokens == len(r.token_ids) for r in rows)


def by_plain_python(rows):
    """All five stages on (doc_id, text, source), each in the plainest way."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    kept = [r for r in rows if test_quality.plain_kept(r[1])]
    stay = {d for _, d in test_simhash.survivors(kept)}
    kept = [r for r in kept if r[0] in stay]
    words = [r[1].encode().split() for r in kept]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    cut = []
    for (doc_id, text, source), w in zip(kept, words):
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        cut.append((doc_id, left if gone else text, source))
    sizes = Counter()
    for _, text, source in cut:
        sizes[source] += len(text.encode().split())
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    target = test_mixing.filled(sizes, weights, 1.5 * sum(sizes.values()))
    encoder = tiktoken.Encoding(
        "byte-level",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path(corpus_pipeline.RANK_FILE)),
        special_tokens={},
    )
    out = []
    for source, size in sizes.items():
        whole = int(target[source] // size)
        members = [(hashlib.md5(f"11:{d}".encode()).hexdigest(), d, t) for d, t, s in cut if s == source]
        ahead = 0
        for _, doc_id, text in sorted(members):
            n = len(text.encode().split())
            more = ahead + n / 2 <= target[source] - whole * size
            ahead += n
            out += [(doc_id, text, tuple(encoder.encode_ordinary(text)))] * (whole + more)
    return out


def test_pipeline_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = corpus_pipeline.run(spark, small).collect()
    want = by_plain_python(rows)
    assert len(want) > 100
    assert Counter((r.doc_id, r.text, tuple(r.token_ids)) for r in got) == Counter(want)
    assert all(r.n_tokens == len(r.token_ids) for r in got)


def test_pipeline_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    prose = " ".join(f"word{i} of the" for i in range(20)) + "."
    rows = [
        (1, prose, "en", "a", len(prose), "x"),
        (2, prose, "en", None, len(prose), "x"),
        (None, None, None, None, None, None),
        (3, "", None, "b", 0, None),
    ]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "unused")
        got = docs.collect()
        assert {r.doc_id for r in got} <= {1} and len(got) <= 2
