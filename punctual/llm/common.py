"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.session import scratch_folder

#: A word is a run of anything but ASCII white space, as ``bytes.split()`` cuts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once
    and outlives the executors that made it."""
    path = scratch_folder(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_key(seed: int, value: Column) -> Column:
    """32 hex digits that order rows like a shuffle, the same in any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))))


def row_key(seed: int) -> Column:
    """The same for rows: by ``doc_id``, among rows of one id by a digest of the text."""
    text = F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    return F.concat(seeded_key(seed, F.col("doc_id")), text)


def give_back() -> None:
    """Hand memory that a task no longer uses back to the system: workers live on
    after it, and their allocators would keep what the largest task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Values of a binary Arrow column, empty where NULL."""
    return [v or b"" for v in column.to_pylist()]


# ---- words of many texts at once ------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    space = _SPACE[data]
    edge = np.empty(len(data) + 1, np.int8)
    word = (~space).view(np.int8)
    edge[0] = word[0] if len(word) else 0
    if len(word):
        edge[1:-1] = word[1:] - word[:-1]
        edge[-1] = -word[-1]
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SALTS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)
#: The first r bytes of a little-endian integer, r up to 8.
_FIRST_BYTES = np.array([(1 << 8 * r) - 1 for r in range(9)], np.uint64)
#: Longer spans, which are few, are hashed one by one.
_SPAN_BYTES = 32


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, equal spans alike wherever they stand.

    Eight bytes at a time go through a mixing bijection, so no pattern of the
    bytes makes different spans agree more often than by chance; hashes of two
    salts together are 128 bits.
    """
    from xxhash import xxh3_64_intdigest

    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    out = sizes.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(_SALTS[salt])
    long = np.flatnonzero(sizes > _SPAN_BYTES)
    todo, at = np.flatnonzero((sizes > 0) & (sizes <= _SPAN_BYTES)), 0
    while len(todo):
        left = sizes[todo] - at
        chunk = eights[starts[todo] + at] & _FIRST_BYTES[np.minimum(left, 8)]
        out[todo] = mix64(out[todo] ^ mix64(chunk + np.uint64(_SALTS[salt])))
        at += 8
        todo = todo[left > 8]
    if len(long):
        whole = memoryview(np.ascontiguousarray(data))
        out[long] = [
            xxh3_64_intdigest(whole[a:b], _SALTS[salt])
            for a, b in zip(starts[long].tolist(), ends[long].tolist())
        ]
    return out


def pieces_of(bodies: list[bytes], most_bytes: int = 1 << 20) -> Iterator[slice]:
    """Stretches of texts of about ``most_bytes``, so that arrays stay small; a
    longer text is one of its own."""
    at = 0
    while at < len(bodies):
        upto, size = at, 0
        while upto < len(bodies) and (upto == at or size + len(bodies[upto]) < most_bytes):
            size += len(bodies[upto]) + 1
            upto += 1
        yield slice(at, upto)
        at = upto


def word_hashes(
    bodies: list[bytes], salts: tuple[int, ...] = (0,), lower: bool = False
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of words per text, and the words' hashes one behind the other, one
    array per salt."""
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begins = np.cumsum(lengths + 1) - lengths - 1
    data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    data = lower_ascii(data) if lower else data
    starts, ends = word_spans(data)
    owner = np.searchsorted(begins, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(bodies))
    return counts, [span_hashes(data, starts, ends, salt) for salt in salts]


def run_hashes(words: np.ndarray, starts: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each of ``starts``.

    Runs are put together from runs of half their length, each step a mixing
    bijection of one side: as safe as the words' hashes, in the logarithm of the
    width.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    odd = np.uint64(_SALTS[salt] | 1)

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mix64(left * odd + mix64(right))

    # runs of a power of two from every word; the last words start none
    power, size, out, done = words, 1, None, 0
    while True:
        if width & size:
            piece = power[starts + done]
            out = piece if out is None else joined(out, piece)
            done += size
        if done == width:
            return out
        power, size = joined(power[:-size], power[size:]), size * 2


# ---- sorted keys as bytes ---------------------------------------------------------


@cache
def _codec():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative integers in as many byte planes as the largest needs, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    head = len(values).to_bytes(8, "little") + bytes([width])
    return head + _codec()[0].compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    planes = np.frombuffer(_codec()[1].decompress(blob[9:]), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as the first one and the differences."""
    if not len(keys):
        return b""
    return int(keys[0]).to_bytes(8, "little") + pack_numbers(keys[1:] - keys[:-1])


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(blob[:8], np.uint64)
    return np.cumsum(np.concatenate([first, unpack_numbers(blob[8:])]), dtype=np.uint64)


# ---- batches ---------------------------------------------------------------------


def regrouped(
    batches: Iterator[pa.RecordBatch], most_bytes: int, column: str
) -> Iterator[pa.Table]:
    """Join incoming batches until their ``column`` holds ``most_bytes``, so
    that vectorised work meets large pieces. A single row may exceed it."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        lengths = _byte_lengths(batch.column(column))
        total = np.cumsum(lengths)
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            room = max(0, most_bytes - size)
            upto = int(np.searchsorted(total, base + room, side="right"))
            upto = max(upto, at + (0 if held else 1))
            if upto > at:
                held.append(batch.slice(at, upto - at))
                size += int(total[upto - 1] - base)
            at = upto
            if at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
    held = []
    give_back()


def _byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(column), 0)
    return np.asarray(lengths.to_numpy(zero_copy_only=False), np.int64)
