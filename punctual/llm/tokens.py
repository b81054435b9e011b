"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is shared by name and loaded once per task. Texts are
cut before they are encoded: in front of white space that follows something
else no match of the pattern can cross, so pieces of at least ``chunk_chars``
characters ending there encode to what the whole text does. A single match
longer than ``long_run`` (a run of white space, letters or symbols; the
library's own matcher gives up on very long ones) is found by its character
class and handed to the library as one match. Ids decode to raw bytes, which need
not be valid UTF-8 piece by piece, and are joined before they are read as text.

Edge cases: NULL encodes like the empty text, to no ids; repeated rows give
repeated results; further columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import give_back

CHUNK_CHARS = 1 << 16
LONG_RUN = 1 << 16
#: Splits nothing: the library merges the whole string as one match.
ONE_MATCH = r"(?s:.+)"


@cache
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


@cache
def encoding(path: str, pattern: str):
    """The library's encoder for a rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={}
    )


@cache
def _decimal(path: str) -> list[bytes]:
    return [b"%d" % i for i in range(max(_ranks(path).values()) + 1)]


_BOUNDARY = regex.compile(r"(?<=\S)(?=\s)")
_RUN = regex.compile(
    rf"\s{{{LONG_RUN},}}|\p{{L}}{{{LONG_RUN},}}|\p{{N}}{{{LONG_RUN},}}"
    rf"|[^\s\p{{L}}\p{{N}}]{{{LONG_RUN},}}"
)


def pieces(text: str, chunk_chars: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` cut where no match of the pattern can cross."""
    at = 0
    while len(text) - at > chunk_chars:
        cut = _BOUNDARY.search(text, at + chunk_chars)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a text, each match of the pattern merged separately."""
    encoder = encoding(path, pattern)
    if len(text) <= CHUNK_CHARS:
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        if len(piece) >= LONG_RUN and _RUN.search(piece):
            whole = encoding(path, ONE_MATCH)
            for match in regex.finditer(pattern, piece):
                ids += whole.encode_ordinary(match.group())
        else:
            ids += encoder.encode_ordinary(piece)
    return ids


def _encoded(column: str, path: str, pattern: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a handful of texts at a time: ids are much larger than the text
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column(column).to_pylist()
                ids = [encode(t, path, pattern) if t else [] for t in texts]
                arrays = [part.column(n) for n in part.schema.names]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(ids, pa.list_(pa.int32()))], schema=schema
                )
        _forget()

    return run


def _forget() -> None:
    """The library's encoders are large: none outlives its task in a worker."""
    encoding.cache_clear()
    _ranks.cache_clear()
    give_back()


def encode_texts(
    docs: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """``docs`` with the ids of every text in a new array column."""
    out = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    from pyspark.sql.pandas.types import to_arrow_schema

    return docs.mapInArrow(_encoded(column, path, pattern, to_arrow_schema(out)), out)


def decode_texts(
    encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """Raw bytes of every id array in a new binary column; NULL gives none."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = encoding(path, pattern)
        for batch in batches:
            bodies = [decoder.decode_bytes(v or []) for v in batch.column(ids).to_pylist()]
            arrays = [batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(bodies, pa.binary())], schema=arrow)
        del decoder
        _forget()

    return encoded.mapInArrow(run, schema)


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, the digest of the ids and of what they
    decode to. Both directions run in one task: the ids never leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decimal = encoding(path, pattern), _decimal(path)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                ids = encode(text, path, pattern) if text else []
                counts.append(len(ids))
                listed = b",".join([decimal[i] for i in ids])
                of_ids.append(hashlib.sha256(listed).hexdigest())
                of_bytes.append(hashlib.sha256(encoder.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        del encoder
        _forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGEST)
