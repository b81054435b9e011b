import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from punctual.llm import ngram

SCHEMA = "doc_id long, text string, fold string"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*lowered.encode().split(), None]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def model(rows):
    """The same model over Python counters."""

    def counted(chosen):
        single, pair = Counter(), Counter()
        for text in chosen:
            t = tokens(text)
            single.update(t)
            pair.update(zip(["start", *t[:-1]], t))
        single["start"] = single[None]
        return single, pair, sum(single.values()) - single["start"]

    train = [r for r in rows if fold(r[0]) != 2]
    single, pair, total = counted(r[1] for r in train)
    words = len(single) - 1 if total else 0
    uniform = 1 / (words + 1)
    fit_single, fit_pair, fit_total = counted(r[1] for r in train if fold(r[0]) != 3)
    seen = {}
    for r in train:
        if fold(r[0]) == 3:
            t = tokens(r[1])
            for v, w in zip(["start", *t[:-1]], t):
                c = fit_single[v]
                p = fit_pair[v, w] / c if c else 0.0
                s = fit_single[w] / max(1, fit_total)
                seen.setdefault(math.frexp(c)[1] if c else 0, []).append((p, s))
    weights, last = [], np.array([0.0, 0.5, 0.5])
    for bucket in range(ngram.BUCKETS):
        if bucket in seen:
            p, s = np.array(seen[bucket]).T
            last = ngram.learned_weights(p, s, uniform, np.ones(len(p)))
        own = last.copy()
        if bucket == 0:
            own[0] = 0
            own /= own.sum()
        weights.append(own)
    out = {}
    for doc_id, text, _ in rows:
        t = tokens(text)
        score = base = 0.0
        for v, w in zip(["start", *t[:-1]], t):
            c = single[v]
            a = weights[math.frexp(c)[1] if c else 0]
            score += math.log10(
                a[0] * (pair[v, w] / c if c else 0) + a[1] * single[w] / max(1, total) + a[2] * uniform
            )
            base += math.log10((single[w] + 1) / (total + words + 1))
        out[doc_id] = (fold(doc_id) == 2, len(t), sum(single[w] > 0 for w in t), total, base, score)
    return out


def corpus(n=150, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"W{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(60))]
        rows.append((i, " ".join(words), "x"))
    return rows


def scored(spark, rows, **knobs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return ngram.scored_texts(df, **knobs).collect()


@pytest.mark.parametrize("knobs", [{}, {"tokens_per_part": 500}])
def test_equals_the_plain_model(spark, knobs):
    rows = corpus()
    want = model(rows)
    for r in scored(spark, rows, **knobs):
        held_out, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        # held-out estimates are binned while the weights are learned
        assert r.score == pytest.approx(score, rel=0.01)


def test_probabilities_add_up_to_one():
    """Over the vocabulary and one unknown token, for any context."""
    weights = ngram.learned_weights(
        np.array([0.5, 0.0, 0.1]), np.array([0.1, 0.0, 0.2]), 0.01, np.array([3.0, 1.0, 2.0])
    )
    assert weights.sum() == pytest.approx(1) and (weights > 0).all()


def test_weights_find_the_better_estimate():
    n = np.ones(1000)
    weights = ngram.learned_weights(np.full(1000, 0.5), np.full(1000, 0.01), 1e-6, n)
    assert weights[0] > 0.98


def test_better_than_the_base_on_held_out_texts(spark, medium):
    out = ngram.scored_texts(spark.read.parquet(f"{medium}/documents.parquet"))
    sums = out.where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert sums.s > 0.9 * sums.b


def test_edges(spark):
    rows = [
        (0, None, ""),
        (1, "", ""),
        (None, "Some words here", None),
        (3, "some WORDS here", ""),
        (3, "some WORDS here", ""),
        (4, "word " * 50_000, ""),
    ]
    got = scored(spark, rows)
    assert len(got) == len(rows)
    assert sorted(r.n_tokens for r in got) == [1, 1, 4, 4, 4, 50_001]
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert scored(spark, []) == []


def test_without_training_texts(spark):
    only = [i for i in range(200) if fold(i) == 2][:5]
    got = scored(spark, [(i, "a b", "") for i in only])
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert all(r.base_score == 0 and r.score <= 0 for r in got)
