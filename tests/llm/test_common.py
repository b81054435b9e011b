import random

import numpy as np
import pytest

from punctual.llm import common


def spans(data, salt=0):
    array = np.frombuffer(data, np.uint8)
    starts, ends = common.word_spans(array)
    words = [data[a:b] for a, b in zip(starts, ends)]
    return words, common.span_hashes(array, starts, ends, salt)


def thue_morse(letters, n):
    return bytes(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("salt", [0, 1])
def test_equal_words_have_equal_hashes_and_others_do_not(salt):
    rng = random.Random(3)
    words = [bytes(rng.choices(b"ab", k=rng.randrange(1, 70))) for _ in range(4000)]
    words += [thue_morse(b"ab", n) for n in (8, 64, 1024, 4096)]
    words += [thue_morse(b"ba", n) for n in (8, 64, 1024, 4096)]
    found, hashes = spans(b" ".join(words), salt)
    assert found == words
    by_word = dict(zip(words, hashes.tolist()))
    assert [by_word[w] for w in words] == hashes.tolist()
    assert len(set(by_word.values())) == len(by_word)


def test_salts_are_independent():
    words, first = spans(b"one two three four", 0)
    _, second = spans(b"one two three four", 1)
    assert not set(first.tolist()) & set(second.tolist())


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 35, 64, 100])
def test_runs(width):
    rng = random.Random(width)
    words = b" ".join(rng.choice([b"a", b"b"]) for _ in range(600))
    words += b" " + words
    listed, hashes = spans(words)
    starts = np.arange(len(listed) - width + 1)
    got = common.run_hashes(hashes, starts, width)
    seen = {}
    for i, h in zip(starts.tolist(), got.tolist()):
        assert seen.setdefault(tuple(listed[i : i + width]), h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(common.run_hashes(hashes, starts[:0], width)) == 0


def test_runs_of_patterns_differ():
    # patterns on which polynomials modulo a power of two agree
    for n in (1024, 2048):
        a, b = (b" ".join(bytes([c]) for c in thue_morse(p, n)) for p in (b"xy", b"yx"))
        both = [common.run_hashes(spans(t)[1], np.zeros(1, np.int64), n)[0] for t in (a, b)]
        assert both[0] != both[1]
