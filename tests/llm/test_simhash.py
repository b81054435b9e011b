import numpy as np
import pytest
from xxhash import xxh64_intdigest

from punctual.llm import simhash

SCHEMA = "doc_id long, text string, fp string"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return lowered.encode().split()


def print_of(text, width=3):
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_linked(prints, radius):
    """Index of the first member reachable from each, by comparing all pairs."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def expected(rows, radius=2):
    prints = [print_of(r[1]) for r in rows]
    roots = smallest_linked(prints, radius)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(r[0], least.get(root, r[0]))
    return sorted(
        ((r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots)), key=str
    )


def grouped(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in simhash.grouped(df).collect()), key=str)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(list("abcdefgh"), 60)) for _ in range(6)]
    rows = []
    for i in range(240):
        words = base[rng.integers(6)].split()
        for _ in range(rng.integers(4)):
            words[rng.integers(len(words))] = f"w{rng.integers(5)}"
        rows.append((1000 - i, " ".join(words), "x"))
    want = expected(rows)
    assert grouped(spark, rows) == want
    assert len({c for _, _, c in want}) < len({p for _, p, _ in want}) < len(rows)


def test_edges(spark):
    rows = [
        (5, None, None),
        (3, "", None),
        (9, " \n\t ", None),
        (7, "One two", None),
        (8, "one\x0btwo", None),
        (1, "É é", None),
        (2, "é é", None),
        (None, "one TWO", None),
        (None, "alone here now", None),
        (4, "same text of five words", None),
        (4, "same text of five words", None),
        (6, "word " * 30_000, None),
    ]
    assert grouped(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert grouped(spark, []) == []


@pytest.mark.parametrize("radius", [0, 1, 2, 7, 12, 22, 30])
def test_near_pairs_equal_brute_force(radius):
    rng = np.random.default_rng(radius)
    n = 400
    prints = rng.integers(0, 2**64 - 1, 2, dtype=np.uint64)[rng.integers(0, 2, n)]
    for _ in range(radius + 2):
        prints ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    buckets = np.sort(rng.integers(0, 3, n))
    found = [
        (int(a), int(b))
        for x, y in simhash.near_pairs(buckets, prints, radius, items=300)
        for a, b in zip(x, y)
    ]
    assert len(found) == len(set(found))
    assert set(found) == {
        (i, j)
        for i in range(n)
        for j in range(i)
        if buckets[i] == buckets[j] and int(prints[i] ^ prints[j]).bit_count() <= radius
    }


def test_buckets_meet_within_the_radius():
    """Every choice of two differing bits leaves some bucket key alike."""
    masks = simhash._piece_masks(8)
    assert sum(masks) == (1 << 64) - 1
    for a in range(64):
        for b in range(a):
            diff = 1 << a | 1 << b
            assert sum(not diff & m for m in masks) >= 6


def test_components(spark):
    chain = [(i + 1, i) for i in range(30)] + [(101, 100), (100, 102), (103, 103)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}
    assert simhash.components(df.limit(0)).count() == 0


def survivors(rows, radius=2):
    roots = smallest_linked([print_of(r[1]) for r in rows], radius)
    least = {}
    for r, root in zip(rows, roots):
        key = (r[0] is None, r[0] or 0)
        least[root] = min(key, least.get(root, key))
    return sorted(least.values())


def kept(spark, rows):
    out = simhash.without_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "fp"]
    got = out.collect()
    assert {tuple(r) for r in got} <= set(rows)
    return sorted((r.doc_id is None, r.doc_id or 0) for r in got)


def test_one_row_of_each_group_stays(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(rng.choice(list("abcdefgh"), 60)) for _ in range(6)]
    rows = []
    for i in range(200):
        words = base[rng.integers(6)].split()
        for _ in range(rng.integers(4)):
            words[rng.integers(len(words))] = f"w{rng.integers(5)}"
        rows.append((None if i % 17 == 0 else 500 - i, " ".join(words), f"f{i}"))
    rows += [(3, base[0], "twice"), (3, base[0], "twice"), (7, "some other text", "x"), (7, None, "y")]
    rows += [(None, "all alone here", "n"), (None, "all alone here", "n")]
    assert kept(spark, rows) == survivors(rows)
    assert kept(spark, []) == []
