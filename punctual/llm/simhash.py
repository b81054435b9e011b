"""SimHash fingerprints and the groups they form.

A fingerprint has a bit for every place where more than half of a text's shingle
hashes have one. Fingerprints are compared in bit-sliced form: 64 fingerprints of
a block lie in 64 words, one word per bit, so that one exclusive-or gives that
bit's difference to a query for all of them. Carry-save adders sum the
differences in bitwise counters, and a block is abandoned as soon as every
counter in it exceeds the radius.

Only fingerprints that can be near meet. Cut into ``blocks`` pieces, two of them
within the radius agree on all but ``radius`` pieces; every choice of that many
pieces is a bucket key. Equal fingerprints have been merged before, so with 8
pieces and radius 2 a bucket can hold at most 2 ** 16 of them, whatever the
number of copies: a third of all documents in one group is one row here. A task
reads its buckets in order, a few at a time. What it hands on per bucket is a
spanning forest, not all pairs.

Components are found by alternating large and small stars on the edges between
different fingerprints, each round a stored table in the shared folder.

Edge cases: NULL texts have no words; a text without words has fingerprint zero
and is linked like any other; a text shorter than a shingle is one shingle;
repeated rows are results of their own; NULL ids are never the smallest; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import as_bytes, give_back, regrouped, stored

SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_CHUNK = 1 << 20


# ---- fingerprints -----------------------------------------------------------------


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of the shingles of a text (UTF-8), lower-cased in ASCII, with repeats."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= width:
        return [xxh64_intdigest(line, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[: len(words) - width + 1].tolist()
    return [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; a group of none gives zero."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some].astype(np.int64)
    starts = np.cumsum(n) - n
    # eight counters of a byte each fit a word, so pieces of 255 are summed first
    pieces = (n + 254) // 255
    first = np.cumsum(pieces) - pieces
    inside = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + inside * 255
    for k in range(8):
        lanes = (hashes >> np.uint64(k)) & np.uint64(0x0101010101010101)
        part = np.add.reduceat(lanes, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        total = np.add.reduceat(part, first, axis=0)
        most = (2 * total > n[:, None]).astype(np.uint64)
        for byte in range(8):
            out[some] |= most[:, byte] << np.uint64(8 * byte + k)
    return out


def _fingerprints_of(bodies: list[bytes], width: int) -> np.ndarray:
    lists = [shingle_hashes(b, width) for b in bodies]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((h for x in lists for h in x), np.uint64, int(counts.sum()))
    return majority(flat, counts)


def fingerprints(docs: DataFrame, width: int = 3, named: bool = False) -> DataFrame:
    """``doc_id`` and the fingerprint of its text as a signed long; if ``named``,
    the digest of the text as ``node`` besides."""
    kept = ["doc_id", "node"] if named else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, _CHUNK, "body"):
            prints = _fingerprints_of(as_bytes(part.column("body")), width)
            columns = [*map(part.column, kept), pa.array(prints.view(np.int64))]
            yield from pa.table(columns, [*kept, "fp"]).to_batches()

    body = F.col("text").cast("binary").alias("body")
    chosen = [F.col("doc_id").cast("long"), *([_node().alias("node")] if named else []), body]
    schema = "doc_id long, node binary, fp long" if named else "doc_id long, fp long"
    return docs.select(*chosen).mapInArrow(run, schema)


def _node() -> Column:
    """Tells texts apart; NULL is the empty one."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))


# ---- bit-sliced comparison -----------------------------------------------------------


def _adder(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is above the radius, from its binary digits."""
    above, equal = over.copy(), np.full_like(over, _ALL)
    for j in range(len(counters) - 1, -1, -1):
        if radius >> j & 1:
            equal &= counters[j]
        else:
            above |= equal & counters[j]
            equal &= ~counters[j]
    return above


def _bit_planes(prints: np.ndarray, lane: np.ndarray, block_starts: np.ndarray) -> np.ndarray:
    planes = np.empty((64, len(block_starts)), np.uint64)
    for bit in range(64):
        ones = ((prints >> np.uint64(bit)) & np.uint64(1)) << lane
        planes[bit] = np.bitwise_or.reduceat(ones, block_starts)
    return planes


def near_pairs(
    bucket: np.ndarray,
    prints: np.ndarray,
    radius: int,
    items: int = 1 << 17,
    asking: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (later, earlier) of the same bucket within ``radius`` bits.

    ``bucket`` must be ascending. Queries against blocks are taken ``items`` at
    a time, each query against its own block and the ones before it. With a
    mask ``asking`` only those members are queries, against all others of their
    bucket.
    """
    if radius > 30:
        raise ValueError("radius above 30 of 64 bits")
    prints = prints.astype(np.uint64, copy=False)
    n = len(bucket)
    if n < 2:
        return
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([heads, [n]]))
    place = np.arange(n) - np.repeat(heads, sizes)
    lane = (place & 63).astype(np.uint64)
    block_starts = np.flatnonzero(lane == 0)
    block_sizes = np.diff(np.concatenate([block_starts, [n]])).astype(np.uint64)
    own_block = np.repeat(np.arange(len(block_starts)), block_sizes.astype(np.int64))
    planes = _bit_planes(prints, lane, block_starts)
    full = _ALL >> (np.uint64(64) - block_sizes)

    # blocks a member is compared with: up to its own, or all of the bucket
    last = own_block if asking is None else np.repeat(own_block[heads + sizes - 1], sizes)
    need = last - np.repeat(own_block[heads], sizes) + 1
    need[np.repeat(sizes, sizes) == 1] = 0
    if asking is not None:
        need[~asking] = 0
    upto = np.cumsum(need)
    start = 0
    while start < n:
        base = int(upto[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, base + items, side="right")))
        counts = need[start:stop]
        query = np.repeat(np.arange(start, stop), counts)
        back = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
        block = last[query] - back
        itself = np.uint64(1) << lane[query]
        inside = itself - np.uint64(1) if asking is None else full[block] & ~itself
        alive = np.where(block == own_block[query], inside, full[block])
        yield from _matches(query, block, alive, prints, planes, block_starts, radius)
        start = stop


def _matches(query, block, alive, prints, planes, block_starts, radius):
    some = alive != 0
    query, block, alive = query[some], block[some], alive[some]
    counters = [np.zeros(len(query), np.uint64) for _ in range(5)]
    over = np.zeros(len(query), np.uint64)
    for bit in range(0, 64, 8):
        if not len(query):
            return
        mine = prints[query]
        d = [
            planes[b][block] ^ (np.uint64(0) - ((mine >> np.uint64(b)) & np.uint64(1)))
            for b in range(bit, bit + 8)
        ]
        ones, a = _adder(counters[0], d[0], d[1])
        ones, b = _adder(ones, d[2], d[3])
        twos, c = _adder(counters[1], a, b)
        ones, a = _adder(ones, d[4], d[5])
        ones, b = _adder(ones, d[6], d[7])
        twos, e = _adder(twos, a, b)
        fours, carry = _adder(counters[2], c, e)
        eights = counters[3] ^ carry
        carry &= counters[3]
        sixteens = counters[4] ^ carry
        over |= carry & counters[4]
        counters = [ones, twos, fours, eights, sixteens]
        alive &= ~_exceeds(counters, over, radius)
        some = alive != 0
        if not some.all():
            query, block, alive, over = query[some], block[some], alive[some], over[some]
            counters = [x[some] for x in counters]
    if not len(query):
        return
    for at in range(0, len(query), 1 << 14):
        part = slice(at, at + (1 << 14))
        bits = np.unpackbits(
            alive[part].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        row, lane = np.nonzero(bits)
        yield query[part][row], block_starts[block[part][row]] + lane


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64, copy=False)).astype(np.int64)


def joined_labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of ``n`` members by the pairs."""
    label = np.arange(n)

    def roots(x: np.ndarray) -> np.ndarray:
        up = label[x]
        while True:
            higher = label[up]
            if np.array_equal(higher, up):
                return up
            up = higher

    for a, b in pairs:
        while True:
            ra, rb = roots(a), roots(b)
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
    while True:
        higher = label[label]
        if np.array_equal(higher, label):
            return label
        label = higher


def whole_buckets(
    batches: Iterator[pa.RecordBatch], most: int = 1 << 18, most_bytes: int = 1 << 26
) -> Iterator[pa.Table]:
    """Tables of complete buckets from a stream sorted by ``bucket``."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < most and sum(t.nbytes for t in held) < most_bytes:
            continue
        whole = pa.concat_tables(held)
        keys = whole.column("bucket").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield whole.slice(0, cut)
            held, rows = [whole.slice(cut)], whole.num_rows - cut
        else:
            held = [whole]
    if held:
        yield pa.concat_tables(held)
    held = []
    give_back()


def _piece_masks(blocks: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def print_links(prints: DataFrame, radius: int = 2, blocks: int = 8) -> DataFrame:
    """Edges (``a`` > ``b`` as unsigned) that join all distinct values of ``fp``
    within ``radius`` bits of each other, directly or over others."""
    pieces = _piece_masks(blocks)
    masks = [_signed(sum(c)) for c in combinations(pieces, blocks - radius)]
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long")))
        for i, m in enumerate(masks)
    ]
    buckets = prints.select("fp").distinct().select(F.explode(F.array(*keys)).alias("bucket"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_buckets(batches):
            keys = part.column("bucket").to_numpy()
            fps = part.column("fp").to_numpy().view(np.uint64)
            label = joined_labels(len(keys), near_pairs(keys, fps, radius))
            moved = np.flatnonzero(label != np.arange(len(keys)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(fps[moved].view(np.int64)),
                    pa.array(fps[label[moved]].view(np.int64)),
                ],
                names=["a", "b"],
            )

    dealt = buckets.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long").distinct()


# ---- components ------------------------------------------------------------------------


def components(edges: DataFrame, label: str = "stars") -> DataFrame:
    """``node`` and the smallest node (``root``) it is connected with, for every
    node of the undirected edges (``a``, ``b``).

    Rounds of large and small stars: minima are partial aggregates and joined
    back as stored tables, which adaptive execution splits where a centre has
    very many neighbours.
    """

    def joined(pairs: DataFrame, least: DataFrame) -> DataFrame:
        least = stored(least, label)
        return pairs.join(least.withColumnRenamed("u", "of"), F.col("u") == F.col("of"))

    def large(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return joined(both, least).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(pairs: DataFrame) -> DataFrame:
        down = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        met = joined(down, least)
        return met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            met.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )

    def tidy(pairs: DataFrame) -> DataFrame:
        return stored(pairs.where("a <> b").distinct(), label)

    def state(pairs: DataFrame) -> tuple:
        mark = F.bitwise_xor if hasattr(F, "bitwise_xor") else F.bit_xor
        return tuple(pairs.agg(F.count("*"), mark(F.xxhash64("a", "b"))).first())

    current = tidy(edges.select("a", "b"))
    seen = state(current)
    while seen[0]:
        current = tidy(small(tidy(large(current))))
        now = state(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def grouped(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """Per document its fingerprint and the smallest id it is linked with."""
    prints = stored(fingerprints(docs, width), "simhash-prints")
    links = stored(print_links(prints, radius), "simhash-links")
    roots = stored(components(links), "simhash-roots")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = stored(
        least.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least"
        ),
        "simhash-rooted",
    )
    named = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    of_print = stored(rooted.join(named, "root").select(F.col("fp").alias("p"), "component_id"), "simhash-of")
    return prints.join(of_print, F.col("fp") == F.col("p")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_copies(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the one with
    the smallest id, NULL last, ties to the smaller digest of the text."""
    prints = stored(fingerprints(docs, width, named=True), "simhash-prints")
    links = stored(print_links(prints, radius), "simhash-links")
    roots = stored(components(links), "simhash-roots").withColumnsRenamed({"node": "of"})
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node"))
    # equal fingerprints are merged before the join, whatever their number
    rooted = (
        prints.groupBy("fp")
        .agg(first.alias("first"))
        .join(roots, F.col("fp") == F.col("of"), "left")
        .select(F.coalesce("root", "fp").alias("root"), "first")
    )
    stays = stored(
        rooted.groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("stays_id"), F.col("first.node").alias("stays")),
        "simhash-stay",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), _node().alias("node")
    )
    kept = rows.join(
        stays,
        (F.col("node") == F.col("stays")) & F.col("id").eqNullSafe(F.col("stays_id")),
        "left_semi",
    )
    # rows that agree in id and text are one
    return kept.dropDuplicates(["id", "node"]).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns]
    )
