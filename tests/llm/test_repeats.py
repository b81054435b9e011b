import hashlib
import random
from collections import Counter

import pytest

from punctual.llm import repeats

SCHEMA = "doc_id long, text string, n_chars long, batch string"


def brute(rows, width):
    words = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digests(spark, rows, **knobs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in repeats.repeat_digests(df, **knobs).collect()), key=str)


def corpus(n=120, seed=2):
    rng = random.Random(seed)
    passage = " ".join(f"p{rng.randrange(50)}" for _ in range(60))
    rows = []
    for i in range(n):
        text = " ".join(f"w{rng.randrange(8)}" for _ in range(rng.randrange(120)))
        if i % 3 == 0:
            text += "\n" + passage + "  " + text[:20]
        rows.append((i, text, len(text), "x"))
    return rows + rows[:3]


@pytest.mark.parametrize("knobs", [{}, {"width": 5}, {"width": 4, "stretch_windows": 512}])
def test_equals_brute_force(spark, knobs):
    rows = corpus()
    assert digests(spark, rows, **knobs) == brute(rows, knobs.get("width", 35))


def test_a_crowded_sketch_loses_nothing(spark):
    """With far fewer cells than windows all are estimated repeated, and the
    second pass still finds exactly the real ones."""
    rows = corpus()
    got = digests(spark, rows, width=5, depth=1, cells_per_window=0)
    assert got == brute(rows, 5)


def test_edges(spark):
    rows = [
        (1, None, None, None),
        (2, "", 0, None),
        (None, "x " * 34, 1, None),
        (3, "y " * 35, 1, None),
        (4, "z " * 36, 1, None),  # overlapping starts in one text
        (5, "a\x0bb\tc " * 12, 1, None),
        (5, "a\x0bb\tc " * 12, 1, None),
        (6, " ".join(map(str, range(60_000))), 1, None),
    ]
    assert digests(spark, rows) == brute(rows, 35)
    assert digests(spark, []) == []


def test_documents_keep_their_columns(spark):
    rows = corpus() + [(-1, None, None, "null"), (-2, "kept  as it\nis", 14, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = repeats.without_repeats(df)
    assert out.schema == df.schema
    got = out.collect()
    digest = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got if r.doc_id < 0)
    assert digest[(-2, hashlib.sha256(b"kept  as it\nis").hexdigest())] == 1
    assert all(r.text is None or r.doc_id == -2 or r.n_chars == len(r.text) for r in got)
    assert len(got) == len(rows)


def test_patterned_words_are_no_repeats(spark):
    # words on which a polynomial hash modulo a power of two agrees for any base
    def patterned(letters):
        return "".join(letters[i.bit_count() & 1] for i in range(1024))

    frame = [f"w{i}" for i in range(40)]
    rows = [
        (n, " ".join([*frame[:20], patterned(letters), *frame[20:]]), 0, "x")
        for n, letters in enumerate(("ab", "ba"))
    ]
    assert digests(spark, rows, width=35) == brute(rows, 35)
    assert all(r[2] == 0 for r in digests(spark, rows, width=35))
