"""Importance resampling of documents towards a target distribution.

Runs of one to ``longest`` words are features, hashed into ``buckets`` by CRC-32.
One pass counts features per bucket over all documents, one over all target
texts; the gain of a bucket is the scaled logarithm of its smoothed share in the
target over that in the documents. Gains are an array of fixed length, looked up
for all features of a text at once; a document weighs the floored mean of its
gains. Gumbel noise from a digest of its id makes the highest scores a sample
without replacement, in proportion to the weights.

Scores are written once, as narrow rows. The cutoff is found on them by
bisection: jobs count rows up to given values and report those numbers only,
each one evaluates the nodes of four halvings. A second bisection over the ids
of the rows tied at the cutoff settles the rest. Rows within the cutoff are
range-partitioned by score, id and row, so that a tie of any size is split, and
a rank is the offset of the range plus the place in it. Nothing is sorted as a
whole, and neither rows nor ids meet in the driver.

Edge cases: a NULL or word-less text has no features and weight 0; a text of any
length is read in pieces of about a megabyte; rows without id have the noise of
the empty id and come last among equal scores; rows with one id and one score
are ranked in an order that is fixed once the scores are written; without target
texts the target is flat; empty documents give no rows; further columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import as_bytes, give_back, stored


@dataclass(frozen=True)
class Resampling:
    """``share_percent`` of the documents with ``min_words`` words are drawn.
    The gains take ``buckets`` numbers on the driver and in every task."""

    buckets: int = 10000
    longest: int = 2
    scale: int = 1000
    seed: int = 7
    min_words: int = 20
    share_percent: int = 25


# ---- features of a text -----------------------------------------------------------

# a byte as part of a word, A-Z in lower case; anything else is a space
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)
_FULL = np.uint32(0xFFFFFFFF)
# the checksum's step for one byte, read off the checksums of single bytes
_STEP = np.zeros(256, np.uint32)
_STEP[0xFF ^ np.arange(256)] = np.array(
    [zlib.crc32(bytes([b])) ^ 0xFFFFFFFF ^ 0x00FFFFFF for b in range(256)], np.uint32
)


def _then_space(sums: np.ndarray) -> np.ndarray:
    """Checksums of the same texts with one space behind them."""
    state = sums ^ _FULL
    return _STEP[(state ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state >> np.uint32(8)) ^ _FULL


def _pieces(body: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text in pieces of about ``size`` bytes, cut between words."""
    clean = body.translate(_WORD_BYTES)
    at = 0
    while at < len(clean):
        upto = clean.find(b" ", at + size)
        upto = len(clean) if upto < 0 else upto
        yield clean[at:upto].split()
        at = upto


def _checksums(words: list[bytes], before: np.ndarray | None = None) -> np.ndarray:
    if before is None:
        return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    return np.fromiter(map(zlib.crc32, words, before.tolist()), np.uint32, len(words))


def features(body: bytes, knobs: Resampling) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of the runs that end in them), piece by piece."""
    carried: list[bytes] = []
    for fresh in _pieces(body):
        words = carried + fresh
        found = []
        sums = _checksums(words)
        for length in range(1, knobs.longest + 1):
            if length > 1:
                sums = _checksums(words[length - 1 :], _then_space(sums[: len(words) - length + 1]))
            # runs within the carried words were found in the piece before
            found.append(sums[max(0, len(carried) - length + 1) :])
        yield len(fresh), np.concatenate(found) % np.uint32(knobs.buckets)
        carried = words[len(words) - knobs.longest + 1 :] if knobs.longest > 1 else []


def _bodies(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[int, bytes]]:
    """Texts of a batch with their place, few of them as Python objects at once."""
    for start in range(0, batch.num_rows, rows):
        for i, body in enumerate(as_bytes(batch.column("__body").slice(start, rows))):
            yield start + i, body


# ---- counts and gains -------------------------------------------------------------


def bucket_counts(texts: DataFrame, knobs: Resampling) -> np.ndarray:
    """Features per bucket over all texts: each task sends one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(knobs.buckets, np.int64)
        for batch in batches:
            for _, body in _bodies(batch):
                for _, found in features(body, knobs):
                    total += np.bincount(found, minlength=knobs.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": total[at]})
        give_back()

    bodies = texts.select(F.col("text").cast("binary").alias("__body"))
    summed = (
        bodies.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    )
    out = np.zeros(knobs.buckets, np.int64)
    for row in summed.collect():  # as many rows as buckets at most
        out[row.bucket] = row.n
    return out


def gains(documents: np.ndarray, target: np.ndarray, knobs: Resampling) -> np.ndarray:
    """Scaled logarithm of the smoothed shares' ratio, per bucket."""
    s, t = documents.astype(np.float64), target.astype(np.float64)
    upper = (t + 1) * (s.sum() + knobs.buckets)
    lower = (s + 1) * (t.sum() + knobs.buckets)
    return np.floor(knobs.scale * np.log(upper / lower)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, knobs: Resampling) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = np.zeros((3, batch.num_rows), np.int64)
            for at, body in _bodies(batch):
                for words, found in features(body, knobs):
                    totals[:, at] += (words, len(found), gain[found].sum())
            words, count, sums = totals
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *map(pa.array, (words, count, sums // np.maximum(count, 1))),
                ],
                names=["doc_id", "n_words", "n_features", "weight"],
            )
        give_back()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("__body"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def scored(docs: DataFrame, target: DataFrame, knobs: Resampling = Resampling()) -> DataFrame:
    """Weights and noisy scores of all documents, written once; ``row`` is unique."""
    gain = gains(bucket_counts(docs, knobs), bucket_counts(target, knobs), knobs)
    name = F.concat(F.lit(f"{knobs.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-knobs.scale * F.log(-F.log((digest + 0.5) / 2.0**32)))
    rows = weighted(docs, gain, knobs).withColumn("score", F.col("weight") + noise)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "importance-scores")


# ---- the draw ---------------------------------------------------------------------


def reaching(rows: DataFrame, column: str, need: int, probes: int = 16) -> int:
    """The smallest value of an integer column that ``need`` rows do not exceed.

    ``need`` is positive and at most the number of rows with a value. Each job
    counts the rows up to ``probes - 1`` values between the bounds left.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        at = sorted({low + (high - low) * i // probes for i in range(1, probes)})
        counts = rows.agg(*[F.count_if(F.col(column) <= v) for v in at]).first()
        for value, n in zip(at, counts):
            if n >= need:
                high = value
                break
            low = value + 1
    return high


def drawn(scores: DataFrame, knobs: Resampling) -> tuple[DataFrame, DataFrame]:
    """The rows within the cutoff and the others. Only rows that agree in score
    and id may be within it beyond the number to draw."""
    # ascending in all columns: highest score, smallest id, NULL last
    rows = scores.withColumn("order", -F.col("score"))
    entitled = rows.where(F.col("n_words") >= knobs.min_words)
    need = knobs.share_percent * entitled.count() // 100
    if not need:
        return rows.where(F.lit(False)), rows
    cutoff = reaching(entitled, "order", need)
    ahead, tied, known = entitled.agg(
        F.count_if(F.col("order") < cutoff),
        F.count_if(F.col("order") == cutoff),
        F.count_if((F.col("order") == cutoff) & F.col("doc_id").isNotNull()),
    ).first()
    inside = F.col("order") < cutoff
    at_cutoff = F.col("order") == cutoff
    if ahead + known >= need:
        ties = entitled.where(at_cutoff & F.col("doc_id").isNotNull())
        # every row at the cutoff counts when all of them are needed
        last = None if ahead + tied == need else reaching(ties, "doc_id", need - ahead)
        at_cutoff = at_cutoff & (F.lit(True) if last is None else F.col("doc_id") <= last)
    chosen = F.coalesce((F.col("n_words") >= knobs.min_words) & (inside | at_cutoff), F.lit(False))
    return rows.where(chosen), rows.where(~chosen)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` from 1 by order, id and row."""
    keys = [F.col("order"), F.asc_nulls_last("doc_id"), F.col("row")]
    dealt = rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "importance-ranges")
    # one row per range: a table of bounded length, summed up in one task
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    return (
        dealt.withColumn("inside", inside)
        .join(offsets, "part")
        .withColumn("rank", F.col("before") + F.col("inside"))
    )


def resampled(docs: DataFrame, target: DataFrame, knobs: Resampling = Resampling()) -> DataFrame:
    """Every document's features, weight, score and rank among the drawn ones
    (NULL if not drawn)."""
    scores = scored(docs, target, knobs)
    within, others = drawn(scores, knobs)
    need = knobs.share_percent * scores.where(F.col("n_words") >= knobs.min_words).count() // 100
    rank = F.when(F.col("rank") <= need, F.col("rank")).cast("long").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return (
        ranked(within)
        .select(*columns, rank)
        .union(others.select(*columns, F.lit(None).cast("long").alias("rank")))
    )
