import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from punctual.llm import importance
from punctual.llm.importance import Resampling

SCHEMA = "doc_id long, text string, row string, rank string, score string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, knobs):
    words = WORD.findall((text or "").translate(LOWER))
    out = [
        zlib.crc32(" ".join(words[i : i + k]).encode()) % knobs.buckets
        for k in range(1, knobs.longest + 1)
        for i in range(len(words) - k + 1)
    ]
    return len(words), out


def brute(rows, target, knobs=Resampling()):
    s = Counter(b for r in rows for b in runs(r[1], knobs)[1])
    t = Counter(b for r in target for b in runs(r[1], knobs)[1])
    ss, tt = sum(s.values()) + knobs.buckets, sum(t.values()) + knobs.buckets
    scored = []
    for doc_id, text, *_ in rows:
        words, found = runs(text, knobs)
        gain = [math.floor(knobs.scale * math.log((t[b] + 1) * ss / ((s[b] + 1) * tt))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        name = f"{knobs.seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-knobs.scale * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append((doc_id, len(found), weight, score, words))
    entitled = [x for x in scored if x[4] >= knobs.min_words]
    entitled.sort(key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = entitled[: knobs.share_percent * len(entitled) // 100]
    ranks = {id(x): i for i, x in enumerate(drawn, 1)}
    return [(*x[:4], ranks.get(id(x))) for x in scored]


def result(spark, rows, target, knobs=Resampling()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = importance.resampled(df, spark.createDataFrame(target, SCHEMA), knobs).collect()
    return [tuple(r) for r in got]


def corpus(n=200, seed=6):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "ÄPFEL", "naïve", "汉字", "X9"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        rows.append((i, rng.choice([" ", ", ", "\n", "-"]).join(words), "r", "k", "s"))
    return rows


TARGET = [(i, f"w1 w2 w3 Über w{i} w5", "", "", "") for i in range(12)]


@pytest.mark.parametrize(
    "knobs",
    [
        Resampling(),
        Resampling(buckets=97, longest=3, share_percent=60, min_words=5),
        Resampling(longest=1, share_percent=100, min_words=0, scale=1),
        Resampling(share_percent=0),
    ],
)
def test_against_brute_force(spark, knobs):
    rows = corpus()
    assert sorted(result(spark, rows, TARGET, knobs), key=str) == sorted(brute(rows, TARGET, knobs), key=str)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, "", "", ""), (2, "", "", "", ""), (3, "?!", "", "", ""), (4, "one", "", "", "")]
    rows += [(None, text, "", "", "")] * 3 + [(9, text, "", "", "")] * 4 + [(10, text[:40], "", "", "")]
    got = result(spark, rows, TARGET, Resampling(share_percent=50))
    assert sorted(got, key=str) == sorted(brute(rows, TARGET, Resampling(share_percent=50)), key=str)
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3]
    assert result(spark, [], TARGET) == []
    assert sorted(result(spark, rows, []), key=str) == sorted(brute(rows, []), key=str)


def test_ties_at_the_cutoff(spark):
    # equal texts and, with a scale of 0, equal scores: the smallest ids are drawn
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i * 3, text, "", "", "") for i in range(500, 0, -1)] + [(None, text, "", "", "")] * 100
    for share in (10, 25, 90):
        knobs = Resampling(scale=0, share_percent=share)
        got = result(spark, rows, TARGET, knobs)
        assert Counter(got) == Counter(brute(rows, TARGET, knobs))


def test_long_text_is_read_in_pieces():
    rng = random.Random(1)
    text = " ".join(f"Wort{rng.randrange(9999)}" for _ in range(400_000)) + " " + "ö" * 2_000_000
    knobs = Resampling(longest=3)
    words, found = 0, Counter()
    for n, buckets in importance.features(text.encode(), knobs):
        words += n
        found.update(buckets.tolist())
    assert (words, found) == (lambda n, b: (n, Counter(b)))(*runs(text, knobs))


def test_documents_like_the_target_are_preferred(spark):
    rows = [(i, " ".join(f"{'abc'[i % 3]}{j % 7}" for j in range(40)), "", "", "") for i in range(600)]
    target = [(1, " ".join(f"a{j % 7}" for j in range(100)), "", "", "")]
    got = result(spark, rows, target, Resampling(share_percent=20))
    taken = Counter(r[0] % 3 for r in got if r[4])
    assert sum(taken.values()) == 120 and taken[0] > 90
