"""Removal of word sequences that occur more than once in the corpus.

A window is a run of words of one document. First pass: every batch of documents
hashes its windows into the cells of a count-min sketch; what it sends is, per
stretch of cells, the sorted list of cells it has hit. Merged over all batches
the counts can only be too high, never too low. Cells hit twice go back to the
batches that hit them, and a window all of whose cells are among them is
estimated to be repeated. Second pass: only those windows are grouped, by a
128-bit hash, and one bit per window says to its batch whether it really occurs
twice. There the words that such windows cover are removed.

The sketch grows with the number of windows (``cells_per_window``) and lies in
stretches of bounded size over the cluster, so its error rate is the same for
any corpus and nothing is broadcast. Within a batch a cell or window counts
twice at most, so a passage that a third of all documents share is one or two
entries per batch.

Edge cases: NULL texts have no words and stay NULL; texts shorter than a window
lose nothing; a sequence that starts twice in one document is repeated, also
where the two overlap; repeated rows are repeats of each other; texts that lose
words come back joined by single spaces; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from punctual.llm.batches import batched, from_blob
from punctual.llm.common import (
    as_bytes,
    give_back,
    mix64,
    pack_numbers,
    pack_sorted,
    pieces_of,
    run_hashes,
    stored,
    unpack_numbers,
    unpack_sorted,
    word_hashes,
)


@dataclass(frozen=True)
class Sketch:
    """A count-min sketch over ``cells`` cells a row, cut into stretches."""

    cells: int
    stretches: int
    depth: int = 2

    @staticmethod
    def sized(windows: int, depth: int, cells_per_window: int, stretch_windows: int) -> Sketch:
        stretches = max(1, -(-windows // stretch_windows))
        return Sketch(
            stretches * -(-max(1024, windows * cells_per_window) // stretches), stretches, depth
        )

    @property
    def stretch(self) -> int:
        return self.cells // self.stretches

    def places(self, keys: np.ndarray, row: int) -> np.ndarray:
        salt = np.uint64((row + 1) * 0xA0761D6478BD642F % 2**64)
        return mix64(keys + salt) % np.uint64(self.cells)


@dataclass(frozen=True)
class Windows:
    """The windows of a batch: their starts among its words and two hashes."""

    counts: np.ndarray  # words per text
    starts: np.ndarray
    first: np.ndarray
    second: np.ndarray


def windows_of(bodies: list[bytes], width: int, both: bool = True) -> Windows:
    salts = (0, 1) if both else (0,)
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    parts += [[np.zeros(0, np.uint64)] for _ in salts]
    before = 0
    for piece in pieces_of(bodies):
        counts, words = word_hashes(bodies[piece], salts)
        total = int(counts.sum())
        room = np.repeat(np.cumsum(counts), counts) - np.arange(total)
        starts = np.flatnonzero(room >= width)
        hashes = [run_hashes(w, starts, width, salt) for salt, w in zip(salts, words)]
        for held, new in zip(parts, (counts, starts + before, *hashes)):
            held.append(new)
        before += total
    whole = [np.concatenate(p) for p in parts]
    return Windows(*whole[:3], whole[-1])


def n_windows(bodies: list[bytes], width: int) -> int:
    return sum(max(0, len(b.split()) - width + 1) for b in bodies)


def _twice_at_most(ordered: np.ndarray) -> np.ndarray:
    """A sorted array with no value more than twice."""
    if len(ordered) < 3:
        return ordered
    keep = np.ones(len(ordered), bool)
    keep[2:] = ordered[2:] != ordered[:-2]
    return ordered[keep]


# ---- first pass -----------------------------------------------------------------------

_HITS = "row int, stretch long, batch string, cells binary"


def _hits(width: int, sketch: Sketch):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_part in rows:
            for name, blob in zip(rows_part.column("batch"), rows_part.column("body")):
                bodies = as_bytes(from_blob(blob.as_py()).column("__body"))
                found = windows_of(bodies, width, both=False)
                out: list[tuple] = []
                for row in range(sketch.depth):
                    cells = _twice_at_most(np.sort(sketch.places(found.first, row)))
                    number = cells // np.uint64(sketch.stretch)
                    heads = np.flatnonzero(np.diff(number, prepend=number[:1] + np.uint64(1)))
                    for a, b in zip(heads, [*heads[1:], len(cells)]):
                        base = number[a] * np.uint64(sketch.stretch)
                        out.append((row, int(number[a]), pack_sorted(cells[a:b] - base)))
                if out:
                    kinds, numbers, blobs = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(kinds, pa.int32()),
                            pa.array(numbers, pa.int64()),
                            pa.array([name.as_py()] * len(out)),
                            pa.array(blobs, pa.binary()),
                        ],
                        names=["row", "stretch", "batch", "cells"],
                    )

    return run


def _merged(sketch: Sketch):
    """Cells of a stretch that were hit twice or more, for each batch that hit them."""

    def run(key: tuple, hits: pa.Table) -> pa.Table:
        give_back()
        count = np.zeros(sketch.stretch, np.uint8)
        lists = [unpack_sorted(b) for b in hits.column("cells").to_pylist()]
        for cells in lists:
            again = cells[1:][cells[1:] == cells[:-1]]
            count[cells] = np.minimum(count[cells] + 1, 2)
            count[again] = 2
        names, blobs = [], []
        for name, cells in zip(hits.column("batch").to_pylist(), lists):
            often = np.unique(cells[count[cells] >= 2])
            if len(often):
                names.append(name)
                blobs.append(pack_sorted(often))
        n = len(names)
        return pa.table(
            {
                "row": pa.array([key[0].as_py()] * n, pa.int32()),
                "stretch": pa.array([key[1].as_py()] * n, pa.int64()),
                "batch": pa.array(names, pa.string()),
                "cells": pa.array(blobs, pa.binary()),
            }
        )

    return run


# ---- second pass ------------------------------------------------------------------------

_KEYS = "part long, batch string, first binary, second binary, twice binary, places binary"


def _ordered_keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (first, second) in order, and which of them each window has."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    return np.stack([a[new], b[new]]), which


def _part_slices(first: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """Stretches of sorted keys that belong to one part."""
    if not len(first):
        return []
    part = ((first >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
    return [(int(part[a]), slice(a, b)) for a, b in zip(edges, [*edges[1:], len(part)])]


def _estimated(width: int, sketch: Sketch, parts: int):
    """Keys of the windows of a batch that the sketch estimates to be repeated.
    The windows' places travel with the first row and come back with its answer."""

    def run(batch: pa.Table, often: pa.Table) -> pa.Table:
        give_back()
        out: list[tuple] = []
        if batch.num_rows and often.num_rows:
            bodies = as_bytes(from_blob(batch.column("body")[0].as_py()).column("__body"))
            found = windows_of(bodies, width)
            likely = np.arange(len(found.first))
            rows = np.asarray(often.column("row"))
            numbers = np.asarray(often.column("stretch"))
            blobs = often.column("cells").to_pylist()
            for row in range(sketch.depth):
                mine = sorted((numbers[i], blobs[i]) for i in np.flatnonzero(rows == row))
                cells = [unpack_sorted(b) + np.uint64(n * sketch.stretch) for n, b in mine]
                known = np.concatenate(cells) if cells else np.zeros(0, np.uint64)
                likely = likely[_among(sketch.places(found.first[likely], row), known)]
            keys, which = _ordered_keys(found.first[likely], found.second[likely])
            twice = np.bincount(which, minlength=keys.shape[1]) > 1
            name, places = batch.column("batch")[0].as_py(), pack_sorted(likely.astype(np.uint64))
            for number, own in _part_slices(keys[0], parts):
                first, second = pack_sorted(keys[0, own]), pack_numbers(keys[1, own])
                out.append((number, name, first, second, pack_numbers(twice[own]), places))
                places = None
        columns = list(zip(*out)) or [()] * 6
        types = [pa.int64(), pa.string(), *[pa.binary()] * 4]
        names = ["part", "batch", "first", "second", "twice", "places"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


_TRUE = "part long, batch string, repeated binary, places binary"


def _confirmed(key: tuple, keys: pa.Table) -> pa.Table:
    """For the keys of one part, batch by batch, whether they occur twice or more."""
    first = [unpack_sorted(b) for b in keys.column("first").to_pylist()]
    second = [unpack_numbers(b) for b in keys.column("second").to_pylist()]
    twice = [unpack_numbers(b) for b in keys.column("twice").to_pylist()]
    _, which = _ordered_keys(np.concatenate(first), np.concatenate(second))
    count = np.bincount(which, weights=np.concatenate(twice) + np.uint64(1))
    ends = np.cumsum([len(f) for f in first])[:-1]
    flags = [pack_numbers(f) for f in np.split(count[which] > 1, ends)]
    return pa.table(
        {
            "part": pa.array([key[0].as_py()] * len(flags), pa.int64()),
            "batch": keys.column("batch"),
            "repeated": pa.array(flags, pa.binary()),
            "places": keys.column("places"),
        }
    )


def _covered(bodies: list[bytes], width: int, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and which words lie in a repeated window."""
    if not answers.num_rows:
        counts = np.fromiter((len(b.split()) for b in bodies), np.int64, len(bodies))
        return counts, np.zeros(int(counts.sum()), bool)
    found = windows_of(bodies, width)
    places = next(p for p in answers.column("places").to_pylist() if p is not None)
    likely = unpack_sorted(places).astype(np.int64)
    _, which = _ordered_keys(found.first[likely], found.second[likely])
    flags = answers.column("repeated").to_pylist()
    order = np.argsort(np.asarray(answers.column("part")))
    repeated = np.concatenate([unpack_numbers(flags[i]) for i in order]).astype(bool)
    at = found.starts[likely[repeated[which]]]
    steps = np.zeros(int(found.counts.sum()) + 1, np.int64)
    steps[at] += 1
    steps[at + width] -= 1
    return found.counts, np.cumsum(steps[:-1]) > 0


# ---- operator -----------------------------------------------------------------------------


def scan_repeats(
    docs: DataFrame,
    finish: Callable[[pa.Table, list[bytes | None], np.ndarray, np.ndarray], pa.Table],
    schema: T.StructType | str,
    width: int = 35,
    depth: int = 2,
    cells_per_window: int = 8,
    stretch_windows: int = 1 << 22,
) -> DataFrame:
    """Find the words to remove and let ``finish`` make the result of a batch
    from its rows, the texts that are left, words per text and words removed."""
    bodied = docs.withColumn("__body", F.col("text").cast("binary"))
    table = batched(
        bodied, "repeats-batches", lambda t: n_windows(as_bytes(t.column("__body")), width)
    )
    windows = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sketch = Sketch.sized(windows, depth, cells_per_window, stretch_windows)
    hits = table.select("batch", "body").mapInArrow(_hits(width, sketch), _HITS)
    often = hits.groupBy("row", "stretch").applyInArrow(_merged(sketch), _HITS)
    keys = (
        table.groupBy("batch")
        .cogroup(often.groupBy("batch"))
        .applyInArrow(_estimated(width, sketch, sketch.stretches), _KEYS)
    )
    real = stored(keys.groupBy("part").applyInArrow(_confirmed, _TRUE), "repeats-found", "none")

    def last(batch: pa.Table, repeats: pa.Table) -> pa.Table:
        give_back()
        rows = from_blob(batch.column("body")[0].as_py())
        bodies = rows.column("__body").to_pylist()
        texts = [b or b"" for b in bodies]
        counts, gone = _covered(texts, width, repeats)
        left: list[bytes | None] = []
        removed = np.zeros(len(texts), np.int64)
        at = 0
        for i, (body, n) in enumerate(zip(texts, counts.tolist())):
            mine = gone[at : at + n]
            at += n
            removed[i] = int(mine.sum())
            words = body.split()
            if removed[i]:
                words = compress(words, (~mine).tolist())
            left.append(None if bodies[i] is None else b" ".join(words))
        return finish(rows, left, counts, removed)

    return table.groupBy("batch").cogroup(real.groupBy("batch")).applyInArrow(last, schema)


def repeat_digests(docs: DataFrame, **knobs) -> DataFrame:
    """Per document its words, the number removed, the digest of what is left."""

    def finish(rows, left, counts, removed) -> pa.Table:
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(b or b"").hexdigest() for b in left]),
            }
        )

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return scan_repeats(narrow, finish, schema, **knobs)


def without_repeats(docs: DataFrame, **knobs) -> DataFrame:
    """``docs`` with the repeated words gone from ``text`` (and ``n_chars``,
    where there is such a column, counted anew). Texts that lose nothing stay as
    they are."""
    arrow = to_arrow_schema(docs.schema)

    def finish(rows, left, counts, removed) -> pa.Table:
        old = rows.column("text").to_pylist()
        new = [o if not n else b.decode() for o, b, n in zip(old, left, removed.tolist())]
        columns = {f.name: rows.column(f.name) for f in arrow}
        columns["text"] = pa.array(new, pa.string())
        if "n_chars" in columns:
            kept = columns["n_chars"].to_pylist()
            sizes = [len(t) if n else o for t, n, o in zip(new, removed.tolist(), kept)]
            columns["n_chars"] = pa.array(sizes, arrow.field("n_chars").type)
        return pa.table(list(columns.values()), schema=arrow)

    return scan_repeats(docs, finish, docs.schema, **knobs)
