import hashlib
import random

import public_tokenizers
import pytest

from punctual.llm import tokens

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def test_pieces_never_change_the_ids():
    rng = random.Random(3)
    encoder = tokens.encoding(PATH, PATTERN)
    for _ in range(200):
        text = "".join(rng.choice("ab1 \n\t'.éß中 ^ 　s") for _ in range(300))
        cut = list(tokens.pieces(text, 7))
        assert "".join(cut) == text
        assert [i for p in cut for i in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["a" * 70_000 + " " + "b" * 70_000, " " * 300_000 + "x y", "^" * 90_000, "don't " * 30_000],
)
def test_long_texts_encode_like_the_library(text):
    whole = tokens.encoding(PATH, PATTERN).encode_ordinary(text)
    assert tokens.encode(text, PATH, PATTERN) == whole


def test_a_run_too_long_for_the_library():
    text = "x" + "\n" * 1_500_000 + "y"
    ids = tokens.encode(text, PATH, PATTERN)
    assert tokens.encoding(PATH, PATTERN).decode_bytes(ids) == text.encode()


def test_digests_and_round_trip(spark):
    texts = [None, "", "Hello  world", "Hello  world", "é中\x00<|endoftext|>", "long word " * 20_000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in tokens.token_digests(df, PATH, PATTERN).collect()}
    encoder = tokens.encoding(PATH, PATTERN)
    for doc_id, text, _ in rows:
        ids = encoder.encode_ordinary(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()

    encoded = tokens.encode_texts(df, PATH, PATTERN)
    assert encoded.columns == [*df.columns, "token_ids"]
    decoded = tokens.decode_texts(encoded, PATH, PATTERN)
    for row in decoded.collect():
        assert bytes(row.decoded) == (row.text or "").encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.token_digests(df, PATH, PATTERN).count() == 0
