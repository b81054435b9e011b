"""Line-first quality rules.

Every line of a text is judged on its own: by its punctuation (prose ends in a
mark, shouting repeats it), as navigation (many separators, or many short
entries without a mark) and as boilerplate (stock phrases, symbols hung on most
words, words said over and over, a repeat of an earlier line). Lines that fail are removed, and a document
that loses too much of its text that way is rejected. Besides, counts over the
whole text are taken, and the base rule on them rejects too short and too
repetitive texts.

Whether prose comes to an end mark is asked of a paragraph, not of each of its
lines: a run of lines up to a blank line, a line that ends in a mark, or a
navigation line. So hard-wrapped prose stays as it would on one line.

All counts of a few megabytes of text are taken at once on byte arrays; texts
are independent of each other, so the plan is one scan without a shuffle.

Edge cases: NULL and empty texts have no words and fail the base rule; a text
of any length is read whole; lines without a word count neither as lost nor as
repeated; equal rows get equal results; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from punctual.llm.common import (
    as_bytes,
    lower_ascii,
    mix64,
    regrouped,
    run_hashes,
    span_hashes,
    word_spans,
)

# Marks that end a line of prose, separators of navigation lines,
# symbols of the base count, stock phrases of page furniture.
END_MARKS = ".!?:;…。！？\"'”’»)]" + (
    # the other sentence terminators of Unicode, in the order of their codes
    "\u0589\u061d\u061e\u061f\u06d4\u0700\u0701\u0702\u07f9\u0837\u0839\u083d\u083e"
    "\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u166e\u1735\u1736\u17d4\u17d5\u1803\u1809"
    "\u1944\u1945\u1aa8\u1aa9\u1aaa\u1aab\u1b4e\u1b4f\u1b5a\u1b5b\u1b5e\u1b5f\u1b7d\u1b7e"
    "\u1b7f\u1c3b\u1c3c\u1c7e\u1c7f\u203c\u203d\u2047\u2048\u2049\u2cf9\u2cfa\u2cfb\u2e2e"
    "\u2e3c\u2e53\u2e54\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8"
    "\ua9c9\uaa5d\uaa5e\uaa5f\uaaf0\uaaf1\uabeb\ufe12\ufe15\ufe16\ufe52\ufe56\ufe57\uff0e"
    "\uff61\U00010a56\U00010a57\U00010f55\U00010f56\U00010f57\U00010f58\U00010f59\U00010f86"
    "\U00010f87\U00010f88\U00010f89\U00011047\U00011048\U000110be\U000110bf\U000110c0"
    "\U000110c1\U00011141\U00011142\U00011143\U000111c5\U000111c6\U000111cd\U000111de"
    "\U000111df\U00011238\U00011239\U0001123b\U0001123c\U000112a9\U0001144b\U0001144c"
    "\U000115c2\U000115c3\U000115c9\U000115ca\U000115cb\U000115cc\U000115cd\U000115ce"
    "\U000115cf\U000115d0\U000115d1\U000115d2\U000115d3\U000115d4\U000115d5\U000115d6"
    "\U000115d7\U00011641\U00011642\U0001173c\U0001173d\U0001173e\U00011944\U00011946"
    "\U00011a42\U00011a43\U00011a9b\U00011a9c\U00011c41\U00011c42\U00011ef7\U00011ef8"
    "\U00011f43\U00011f44\U00016a6e\U00016a6f\U00016af5\U00016b37\U00016b38\U00016b44"
    "\U00016e98\U0001bc9f\U0001da88"
    # colons, semicolons, closing brackets and quotes of the scripts that use them
    "\u061b\u0f0d\u0f0e\u300b\u300d\u300f\u3011\uff09\uff1a\uff1b\uff63"
)
SEPARATORS = "|›»>•·"
SYMBOLS = "#*$%&|<>"
PHRASES = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "enable javascript",
    "lorem ipsum",
    "sign up",
    "log in",
    "click here",
    "read more",
    "share this",
    "subscribe to",
    "add to cart",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    max_lost: float = 0.5  # share of the characters in words
    separator_share: float = 0.2  # separators per word of a navigation line
    min_separators: int = 3
    symbol_share: float = 0.3  # words with a symbol
    shout_share: float = 0.5  # words that end in a doubled mark, or are upper case
    short_line: int = 2  # words of a line that needs no mark
    words_per_mark: int = 60  # a paragraph that ends without a mark has one so often
    stutter_share: float = 0.3  # words equal to the word before them
    phrase_words: int = 25  # stock phrases condemn only lines up to this length


def _marks(characters: str, data: np.ndarray) -> np.ndarray:
    """True at the last byte of each of the characters."""
    hit = np.zeros(len(data), bool)
    for c in characters:
        code = c.encode()
        at = data == code[-1]
        for back, byte in enumerate(reversed(code[:-1]), 1):
            at[back:] &= data[:-back] == byte
            at[:back] = False
        hit |= at
    return hit


# letters, digits, all that is not ASCII, and what joins parts of a word
_NAME_BYTES = np.array(
    [b >= 0x80 or chr(b).isalnum() or chr(b) in "_-'" for b in range(256)], bool
)
_END_CODES = np.array(sorted(map(ord, END_MARKS)))


def _last_characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code point of the last character of each word."""
    at = ends - 1
    code = data[at].astype(np.int64)
    more = (code & 0xC0) == 0x80
    code[more] &= 0x3F
    for back in (1, 2, 3):
        byte = data[np.maximum(at - back, starts)].astype(np.int64)
        follows = (byte & 0xC0) == 0x80
        bits = byte & np.where(follows, 0x3F, 0x7F >> (back + 1))
        code = np.where(more, code | bits << (6 * back), code)
        more &= follows
    return code


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def repeated_words(
    hashes: np.ndarray, owner: np.ndarray, width: int
) -> np.ndarray:
    """Which words lie in a window of ``width`` that occurs again in its text."""
    n = len(hashes) - width + 1
    covered = np.zeros(len(hashes), bool)
    if n <= 0:
        return covered
    inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
    key = run_hashes(hashes, inside, width)
    key = mix64(key ^ mix64(owner[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(inside), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, inside[again], 1)
    np.add.at(steps, inside[again] + width, -1)
    return np.cumsum(steps[:-1]) > 0


@dataclass(frozen=True)
class Measured:
    """Counts per text, and per line where it lies and whether it stays."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    base_failed: np.ndarray
    kept: np.ndarray
    line_text: np.ndarray
    line_start: np.ndarray  # in its text, in bytes
    line_end: np.ndarray
    line_stays: np.ndarray


def measure(texts: list[bytes], rules: Rules = Rules()) -> Measured:
    """Judge several texts (UTF-8) at once."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    # a line break between texts: neither words nor lines cross it
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    n = len(texts)

    w_start, w_end = word_spans(data)
    owner = np.searchsorted(starts, w_start, side="right") - 1
    n_words = np.bincount(owner, minlength=n)
    filled = np.zeros(len(data) + 1, np.int8)
    filled[w_start] += 1
    filled[w_end] -= 1
    in_word = np.cumsum(filled[:-1], dtype=np.int8).astype(bool)
    letter = in_word & ((data & 0xC0) != 0x80)
    symbol = _marks(SYMBOLS, data)
    hashes = span_hashes(data, w_start, w_end)
    repeats = repeated_words(hashes, owner, rules.window)
    n_repeat = np.bincount(owner, weights=repeats, minlength=n).astype(np.int64)

    # lines with a word
    breaks = np.flatnonzero(data == 10)
    l_start = np.concatenate([[0], breaks[:-1] + 1])
    l_words = np.searchsorted(w_start, breaks) - np.searchsorted(w_start, l_start)
    real = l_words > 0
    l_start, l_end, l_words = l_start[real], breaks[real], l_words[real]
    l_owner = np.searchsorted(starts, l_start, side="right") - 1
    l_key = mix64(
        span_hashes(data, l_start, l_end) ^ mix64(l_owner.astype(np.uint64) + np.uint64(1))
    )
    first = np.zeros(len(l_key), bool)
    first[np.unique(l_key, return_index=True)[1]] = True
    n_dup = np.bincount(l_owner, weights=~first, minlength=n).astype(np.int64)

    l_chars = _sums(letter, l_start, l_end)
    w_first = np.searchsorted(w_start, l_start)
    w_after = w_first + l_words

    # navigation
    bars = _sums(_marks(SEPARATORS, data), l_start, l_end)
    menu = (bars >= rules.min_separators) & (bars >= rules.separator_share * l_words)
    # punctuation
    mark = np.isin(_last_characters(data, w_start, w_end), _END_CODES)
    ends_well = mark[w_after - 1]
    opens = np.ones(len(l_start), bool)
    opens[1:] = (l_start[1:] != l_end[:-1] + 1) | (l_owner[1:] != l_owner[:-1])
    opens[1:] |= ends_well[:-1] | menu[:-1] | menu[1:]
    p_first = np.flatnonzero(opens)
    p_last = np.append(p_first[1:], len(opens))[: len(p_first)] - 1
    p_words = w_after[p_last] - w_first[p_first]
    marked = _sums(mark, w_first[p_first], w_after[p_last])
    p_fails = ~ends_well[p_last] & (marked * rules.words_per_mark < p_words)
    last, ahead = data[w_end - 1], data[np.maximum(w_end - 2, w_start)]
    doubled = (w_end - w_start >= 2) & (last == ahead) & np.isin(last, [33, 63])
    upper = _sums((data >= 65) & (data <= 90), w_start, w_end) >= 2
    upper &= _sums((data >= 97) & (data <= 122), w_start, w_end) == 0
    shouted = _sums(doubled | upper, w_first, w_after) > rules.shout_share * l_words
    shouted &= l_words > rules.short_line
    unmarked = np.repeat(p_fails, p_last - p_first + 1) & (l_words > rules.short_line)
    # boilerplate
    hung = _sums(symbol, w_start, w_end) > 0
    noisy = (_sums(hung, w_first, w_after) > rules.symbol_share * l_words) & (
        l_words > rules.short_line
    )
    echoes = np.zeros(len(w_start), bool)
    echoes[1:] = hashes[1:] == hashes[:-1]
    echoes[w_first] = False  # a line is judged by itself
    stutter = _sums(echoes, w_first, w_after) > rules.stutter_share * l_words
    stock = np.zeros(len(l_start), bool)
    small = lower_ascii(data).tobytes()
    inside_name = _NAME_BYTES[data]
    for phrase in PHRASES:
        at = small.find(phrase.encode())
        while at >= 0:
            line = np.searchsorted(l_start, at, side="right") - 1
            # a phrase begins and ends where words do, not inside of "catalog in"
            alone = not (inside_name[at - 1] if at else False) and not inside_name[at + len(phrase)]
            if alone and line >= 0 and l_words[line] <= rules.phrase_words:
                stock[line] = True
            at = small.find(phrase.encode(), at + 1)
    fails = unmarked | shouted | menu | noisy | stutter | stock | ~first

    word_chars = np.bincount(l_owner, weights=l_chars, minlength=n).astype(np.int64)
    lost = np.bincount(l_owner, weights=l_chars * fails, minlength=n)
    base_failed = (n_words < rules.min_words) | (
        100 * n_repeat > rules.max_repeat_percent * n_words
    )
    kept = ~base_failed & (lost <= rules.max_lost * word_chars)
    return Measured(
        n_words,
        word_chars,
        _sums(symbol, starts, ends),
        n_dup,
        n_repeat,
        base_failed,
        kept,
        l_owner,
        l_start - starts[l_owner],
        l_end - starts[l_owner],
        ~fails,
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FLAGS = ("base_failed", "kept")
_CHUNK = 1 << 20


def judged(docs: DataFrame, rules: Rules = Rules(), columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all) with the counts and both verdicts."""
    kept = docs.columns if columns is None else columns
    renamed = {c: f"__{c}" for c in kept if c in (*COUNTS, *FLAGS)}
    chosen = docs.select(
        *[F.col(c).alias(renamed.get(c, c)) for c in kept],
        F.col("text").cast("binary").alias("__body"),
    )
    schema = T.StructType(
        [f for f in chosen.schema.fields if f.name != "__body"]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField(c, T.BooleanType()) for c in FLAGS]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, _CHUNK, "__body"):
            found = measure(as_bytes(part.column("__body")), rules)
            own = [part.column(f.name) for f in arrow if f.name in part.schema.names]
            new = [pa.array(getattr(found, c)) for c in (*COUNTS, *FLAGS)]
            yield from pa.Table.from_arrays([*own, *new], schema=arrow).to_batches()

    return chosen.mapInArrow(run, schema)


def accepted(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    clash = [c for c in docs.columns if c in (*COUNTS, *FLAGS)]
    good = judged(docs, rules).where("kept").drop(*COUNTS, *FLAGS)
    return good.withColumnsRenamed({f"__{c}": c for c in clash}).select(*docs.columns)


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with a column ``cleaned_text``: the lines that stay, in order."""
    bodied = docs.withColumn("__body", F.col("text").cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField("cleaned_text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, _CHUNK, "__body"):
            texts = as_bytes(part.column("__body"))
            found = measure(texts, rules)
            lines: list[list[bytes]] = [[] for _ in texts]
            stay = np.flatnonzero(found.line_stays)
            for i, a, b in zip(found.line_text[stay], found.line_start[stay], found.line_end[stay]):
                lines[i].append(texts[i][a:b])
            new = pa.array([b"\n".join(x).decode() for x in lines], pa.string())
            own = [part.column(f.name) for f in docs_fields]
            yield from pa.Table.from_arrays([*own, new], schema=arrow).to_batches()

    docs_fields = docs.schema.fields
    return bodied.mapInArrow(run, schema)
