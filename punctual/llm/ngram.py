"""Text scores by a bigram model with deleted interpolation.

The probability of a token after its predecessor mixes three maximum-likelihood
estimates: of the pair, of the token, and the uniform one over the vocabulary
and one unknown token. The weights depend on how often the predecessor was seen
(one bucket per power of two) and are learned by expectation-maximisation on a
part of the training documents, against counts from the others; the model then
counts all of them. Words are lower-cased in ASCII; each text ends in an end
token, and its first word follows a start token.

Counts are exact over the whole corpus. A batch of documents sends each of its
distinct words and pairs once, as sorted 64-bit hashes with its own counts, to
the partition that owns the hash range; there they are summed and the sums go
back to the batch. A word in every document is one entry per batch. Only totals
and the weights (a few numbers per bucket) reach the driver.

Edge cases: NULL and empty texts are the end token alone; with no training text
every estimate but the uniform one is zero; repeated rows are separate texts;
rows without id count as training; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.batches import batched, from_blob
from punctual.llm.common import (
    as_bytes,
    give_back,
    mix64,
    pack_numbers,
    pack_sorted,
    pieces_of,
    stored,
    unpack_numbers,
    unpack_sorted,
    word_hashes,
)

_END = np.uint64(0x5851F42D4C957F2C)
_START = np.uint64(0x14057B7EF767814E)
_PAIR_A, _PAIR_B = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x369DEA0F31A53F85)
BUCKETS = 48
_GRID = 16  # steps per power of two in the histogram of held-out tokens


@dataclass(frozen=True)
class Folds:
    """Documents by a checksum of their id: scored only, and held out of the
    counts while the weights are learned."""

    folds: int = 7
    scored_only: int = 2
    weights_from: int = 3

    def number(self, doc_id: Column) -> Column:
        text = F.coalesce(doc_id.cast("string"), F.lit(""))
        return (F.crc32(text.cast("binary")) % self.folds).cast("int")


@dataclass(frozen=True)
class Tokens:
    """Tokens of a batch, their distinct keys in order, and where each is found."""

    sizes: np.ndarray  # tokens per text
    owner: np.ndarray
    keys: np.ndarray  # sorted; even: single tokens, odd: pairs
    single: np.ndarray  # per token, index in keys
    before: np.ndarray  # of its predecessor; of the end token for a start
    pair: np.ndarray


def tokens_of(bodies: list[bytes]) -> Tokens:
    parts = [word_hashes(bodies[piece], lower=True) for piece in pieces_of(bodies)]
    counts = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in parts]])
    words = np.concatenate([np.zeros(0, np.uint64), *[p[1][0] for p in parts]])
    sizes = counts + 1
    ends = np.cumsum(sizes) - 1
    total = int(sizes.sum())
    token = np.empty(total, np.uint64)
    inner = np.ones(total, bool)
    inner[ends] = False
    token[inner] = words & ~np.uint64(1)
    token[ends] = _END
    previous = np.empty(total, np.uint64)
    previous[1:] = token[:-1]
    first = ends + 1 - sizes
    previous[first] = _START
    pairs = mix64(previous * _PAIR_A + token * _PAIR_B) | np.uint64(1)
    keys, where = np.unique(np.concatenate([token, pairs]), return_inverse=True)
    single, pair = where[:total], where[total:]
    before = np.empty(total, np.int64)
    before[1:] = single[:-1]
    # the start is seen once per text, as often as the end
    before[first] = single[ends]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return Tokens(sizes, owner, keys, single, before, pair)


# ---- counting ---------------------------------------------------------------------

_SENT = "part long, batch string, keys binary, trained binary, withheld binary"
_BACK = (
    "batch string, part long, trained binary, withheld binary,"
    " words long, tokens long, withheld_tokens long"
)


def _sending(parts: int, folds: Folds):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part_of in rows:
            for name, blob in zip(part_of.column("batch"), part_of.column("body")):
                docs = from_blob(blob.as_py())
                found = tokens_of(as_bytes(docs.column("__body")))
                fold = np.asarray(docs.column("fold"))[found.owner]
                n = len(found.keys)
                totals = []
                for chosen in (fold != folds.scored_only, fold == folds.weights_from):
                    count = np.bincount(found.single[chosen], minlength=n)
                    totals.append(count + np.bincount(found.pair[chosen], minlength=n))
                part = ((found.keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                edges = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
                slices = [slice(a, b) for a, b in zip(edges, [*edges[1:], n])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[edges].astype(np.int64)),
                        pa.array([name.as_py()] * len(slices)),
                        pa.array([pack_sorted(found.keys[s]) for s in slices], pa.binary()),
                        *[
                            pa.array([pack_numbers(t[s]) for s in slices], pa.binary())
                            for t in totals
                        ],
                    ],
                    names=["part", "batch", "keys", "trained", "withheld"],
                )

    return run


def _summing(key: tuple, sent: pa.Table) -> pa.Table:
    """Sum the counts of one hash range and answer every batch that asked."""
    lists = [unpack_sorted(b) for b in sent.column("keys").to_pylist()]
    keys, where = np.unique(np.concatenate(lists), return_inverse=True)
    sums = []
    for name in ("trained", "withheld"):
        own = np.concatenate([unpack_numbers(b) for b in sent.column(name).to_pylist()])
        sums.append(np.bincount(where, weights=own, minlength=len(keys)).astype(np.int64))
    words = (keys & np.uint64(1)) == 0
    totals = {
        "words": int((words & (sums[0] > 0)).sum()),
        "tokens": int(sums[0][words].sum()),
        "withheld_tokens": int(sums[1][words].sum()),
    }
    names, answers, at = sent.column("batch").to_pylist(), ([], []), 0
    for keys_of in lists:
        mine = where[at : at + len(keys_of)]
        at += len(keys_of)
        for total, out in zip(sums, answers):
            out.append(pack_numbers(total[mine]))
    return pa.table(
        {
            "batch": pa.array([*names, None], pa.string()),
            "part": pa.array([key[0].as_py()] * (len(names) + 1), pa.int64()),
            "trained": pa.array([*answers[0], None], pa.binary()),
            "withheld": pa.array([*answers[1], None], pa.binary()),
            **{k: pa.array([0] * len(names) + [v], pa.int64()) for k, v in totals.items()},
        }
    )


def _counts(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts aligned with a batch's keys: trained, and withheld of them."""
    order = np.argsort(np.asarray(answers.column("part")))
    out = []
    for name in ("trained", "withheld"):
        blobs = answers.column(name).to_pylist()
        out.append(np.concatenate([unpack_numbers(blobs[i]) for i in order]).astype(np.float64))
    return out[0], out[1]


# ---- weights -------------------------------------------------------------------------


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2(count))."""
    return np.minimum(np.frexp(count)[1], BUCKETS - 1)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def learned_weights(
    pair: np.ndarray, single: np.ndarray, uniform: float, n: np.ndarray, rounds: int = 60
) -> np.ndarray:
    """Mixture weights that make held-out tokens most likely; ``n`` tokens have
    the estimates ``pair``, ``single`` and ``uniform``. One token is added for
    each estimate, so that none is ruled out."""
    parts = np.stack([pair, single, np.full(len(n), uniform)])
    weights = np.full(3, 1 / 3)
    for _ in range(rounds):
        shares = weights[:, None] * parts
        shares /= shares.sum(axis=0)
        weights = (shares @ n + 1) / (n.sum() + 3)
    return weights


_CELLS = "bucket int, pair int, single int, n long"
_NEVER = -(1 << 20)  # the cell of an estimate that is zero


def _grid(estimate: np.ndarray) -> np.ndarray:
    cells = np.full(len(estimate), _NEVER, np.int64)
    some = estimate > 0
    cells[some] = np.rint(np.log2(estimate[some]) * _GRID).astype(np.int64)
    return cells


def _ungrid(cells: np.ndarray) -> np.ndarray:
    return np.where(cells == _NEVER, 0.0, 2.0 ** (np.maximum(cells, -4000) / _GRID))


def _held_out_cells(fit_tokens: int, folds: Folds):
    """Histogram of the withheld tokens of a batch: context bucket by estimates."""

    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        rows, found = _opened(batch)
        fold = np.asarray(rows.column("fold"))[found.owner]
        trained, withheld = _counts(answers)
        fit = trained - withheld
        mine = fold == folds.weights_from
        context = fit[found.before[mine]]
        pair = _ratio(fit[found.pair[mine]], context)
        single = fit[found.single[mine]] / max(1, fit_tokens)
        places = np.stack([bucket_of(context), _grid(pair), _grid(single)], axis=1)
        cells, n = np.unique(places, axis=0, return_counts=True)
        return pa.table(
            {
                "bucket": pa.array(cells[:, 0], pa.int32()),
                "pair": pa.array(cells[:, 1], pa.int32()),
                "single": pa.array(cells[:, 2], pa.int32()),
                "n": pa.array(n, pa.int64()),
            }
        )

    return run


def _opened(batch: pa.Table) -> tuple[pa.Table, Tokens]:
    docs = from_blob(batch.column("body")[0].as_py())
    return docs, tokens_of(as_bytes(docs.column("__body")))


def _weights(cells: DataFrame, uniform: float) -> np.ndarray:
    """Weights per bucket; a bucket without held-out tokens takes those of the
    nearest one below that has some, an unseen context never trusts the pair."""

    def run(key: tuple, mine: pa.Table) -> pa.Table:
        pair, single = (_ungrid(np.asarray(mine.column(c))) for c in ("pair", "single"))
        found = learned_weights(pair, single, uniform, np.asarray(mine.column("n"), np.float64))
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()], pa.int32()),
                "weights": pa.array([found.tolist()], pa.list_(pa.float64())),
            }
        )

    summed = cells.groupBy("bucket", "pair", "single").agg(F.sum("n").alias("n"))
    rows = (
        summed.groupBy("bucket").applyInArrow(run, "bucket int, weights array<double>").collect()
    )
    known = {r.bucket: np.array(r.weights) for r in rows}
    out = np.empty((BUCKETS, 3))
    last = np.array([0.0, 0.5, 0.5])
    for bucket in range(BUCKETS):
        last = known.get(bucket, last)
        out[bucket] = last
        if bucket == 0:
            out[0, 0] = 0.0
            out[0] /= out[0].sum()
    return out


# ---- scores ---------------------------------------------------------------------------

_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def scored_texts(
    docs: DataFrame, folds: Folds = Folds(), tokens_per_part: int = 1 << 22
) -> DataFrame:
    """Per document the log10 probability under the model, and under add-one
    counts of single tokens (``base_score``)."""
    fold = folds.number(F.col("doc_id"))
    narrow = docs.select(
        F.col("doc_id").cast("long"),
        fold.alias("fold"),
        F.col("text").cast("binary").alias("__body"),
    )

    def measure(rows: pa.Table) -> int:
        return sum(len(b.split()) + 1 for b in as_bytes(rows.column("__body")))

    table = batched(narrow, "ngram-batches", measure)
    total = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(1, -(-total // tokens_per_part))
    sent = table.select("batch", "body").mapInArrow(_sending(parts, folds), _SENT)
    answers = stored(sent.groupBy("part").applyInArrow(_summing, _BACK), "ngram-counts", "none")
    names = ("words", "tokens", "withheld_tokens")
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).first()
    vocabulary, train_tokens, fit_tokens = sums[0], sums[1], sums[1] - sums[2]
    mine = answers.where(F.col("batch").isNotNull()).drop(*names)
    uniform = 1.0 / (vocabulary + 1)

    cells = (
        table.groupBy("batch")
        .cogroup(mine.groupBy("batch"))
        .applyInArrow(_held_out_cells(fit_tokens, folds), _CELLS)
    )
    weights = _weights(cells, uniform)

    def last(batch: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        rows, found = _opened(batch)
        trained, _ = _counts(answers)
        single = trained[found.single]
        context = trained[found.before]
        mixed = weights[bucket_of(context)]
        chance = (
            mixed[:, 0] * _ratio(trained[found.pair], context)
            + mixed[:, 1] * (single / max(1, train_tokens))
            + mixed[:, 2] * uniform
        )
        base = np.log10((single + 1) / (train_tokens + vocabulary + 1))
        n = len(found.sizes)
        per_text = [
            np.bincount(found.owner, weights=w, minlength=n)
            for w in (single > 0, base, np.log10(chance))
        ]
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": pa.array(np.asarray(rows.column("fold")) == folds.scored_only),
                "n_tokens": pa.array(found.sizes, pa.int64()),
                "n_known": pa.array(per_text[0].astype(np.int64)),
                "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
                "base_score": pa.array(per_text[1]),
                "score": pa.array(per_text[2]),
            }
        )

    return table.groupBy("batch").cogroup(mine.groupBy("batch")).applyInArrow(last, _SCORED)
