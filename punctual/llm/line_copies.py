"""Lines that many documents share, kept in one of them.

Texts are split at line feeds and every line is normalised: ASCII white space
goes at both ends, A-Z become lower case. Lines long enough are exploded with
their position and hashed (the first 128 bits of SHA-256). A key found in at
least ``min_docs`` distinct documents loses all its lines but those of the
largest ``doc_id`` that holds it, and what stays is put together by position.

Only keys, ids and positions meet other documents. A key is first counted once
per document, by key and document, so a line in a third of all documents is
spread like any other; what then meets per key has been summed up by each task.
Where shared keys are joined to lines again, adaptive execution splits a hot
key. Texts move once, to the positions they lose.

All of it is built-in expressions. Edge cases: a NULL or empty text is one empty
line; rows with one ``doc_id`` are one document when documents are counted, and
each is cut by itself; rows without id count as one document, smaller than any
other; a line that repeats inside the document that keeps it stays each time; an
empty table gives no rows; further columns pass through whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def normalised(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is many times faster than translate(), and the same on ASCII
    plain = F.octet_length(bare) == F.char_length(bare)
    mapped = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(bare)).otherwise(mapped)


def _text_key() -> Column:
    """Tells texts of one id apart; rows that agree in both lose the same lines."""
    return F.xxhash64("text").alias("text_key")


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, text_key, pos, key`` of every line of at least ``min_chars``."""
    exploded = docs.select("doc_id", _text_key(), F.posexplode(lines_of(F.col("text"))))
    long = exploded.where(F.char_length(F.btrim("col", F.lit(SPACE))) >= min_chars)
    digest = F.unhex(F.sha2(normalised(F.col("col")), 256))
    return long.select("doc_id", "text_key", "pos", F.substring(digest, 1, 16).alias("key"))


def dropped_positions(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, text_key, dropped``: positions of the lines each text loses."""
    lines = stored(long_lines(docs, min_chars), "line-keys")
    shared = (
        lines.select("key", "doc_id")
        .distinct()
        .groupBy("key")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("key", "keeper")
    )
    return (
        lines.join(shared, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def cut_rows(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines``, ``n_dropped`` and ``kept``."""
    dropped = dropped_positions(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_text"), "dropped"
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", _text_key(), "text")
    # joined before the texts are split: only whole texts are moved
    joined = rows.join(
        dropped,
        F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text")),
        "left",
    )
    split = joined.select("row", "text", "dropped", lines_of(F.col("text")).alias("lines"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    # array_except looks positions up in a hash set, so long texts stay linear
    staying = F.transform(
        F.array_except(numbers, F.col("dropped")), lambda at: F.get(F.col("lines"), at)
    )
    whole = F.coalesce(F.col("text"), F.lit(""))
    return split.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), whole)
        .otherwise(F.array_join(staying, "\n"))
        .alias("kept"),
    )


def without_shared_lines(docs: DataFrame, **knobs) -> DataFrame:
    """``docs`` with the shared lines cut from ``text``; a text that loses none
    stays as it is, NULL included."""
    cut = cut_rows(docs, **knobs)
    columns = [
        F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text")).alias(c)
        if c == "text"
        else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    return cut.select(*columns)


def line_digests(docs: DataFrame, **knobs) -> DataFrame:
    """Lines, dropped lines and the digest of what stays, per row."""
    return cut_rows(docs.select("doc_id", "text"), **knobs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )
