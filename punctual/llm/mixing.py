"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the mix in proportion to its weight, but no
source may be repeated more than ``max_epochs`` times. Sources above that are
clamped and what they leave is shared among the others by weight, until none is
above. Sorted by the ratio of cap to weight, that fixed point is one line of
running sums: the water level is the first quotient (rest of the mix) / (rest
of the weights) that does not lift its own source over its cap.

A source whose target is ``t`` words of its ``s`` is taken ``floor(t / s)``
times whole, and the rest as a prefix of its documents in a seeded order. The
prefix ends where its words come nearest, so a source misses its target by at
most half a document. Where it ends is found from word counts per (source,
bucket of the order). The rows of the bucket it ends in are range-partitioned by
key and row, so that a bucket of any size is split, and added up within a range
behind the totals of the ranges before: no source ever meets in one task, and
what comes out is one row per source.

Edge cases: NULL or word-less texts have size 0 and are repeated with their
source like others, without counting; NULL is a source of its own, the last
one; rows with one ``doc_id`` (NULL included) are ordered by a digest of their
text; repeated rows share a place of the order, and where the prefix ends among
them as many are taken as it needs (which of them is left open); an empty table
gives no rows; further columns pass through. The sources' own table, one row
each, is sorted in one task: it grows with the number of names, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import n_words, row_key, stored


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code-point order, NULL last."""

    weights: Sequence[float] = (3, 1, 2)
    total_share: float = 1.5
    max_epochs: int = 2
    seed: int = 11
    bucket_digits: int = 3


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Target words per source, from rows (source, source_size)."""
    named = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(named) - 1) % len(mix.weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in mix.weights]), place)
    ranked = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size").cast("double") * mix.max_epochs
    )
    rows = ranked.where("source_size > 0")
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum(F.col("source_size").cast("double")).over(everything) * mix.total_share
    steps = rows.select(
        F.row_number().over(filled).alias("step"),
        (F.col("cap") / F.col("weight")).alias("ratio"),
        (
            (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(rest)
        ).alias("level"),
    )
    level = steps.where("level <= ratio").agg(F.min_by("level", "step")).scalar()
    wanted = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return ranked.select("source", "source_size", wanted.alias("target"))


def _cuts(narrow: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: size, target, whole repetitions, and the last key of
    the seeded order that is taken once more."""
    bucket = F.substring("order_key", 1, mix.bucket_digits)
    per_bucket = (
        narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    )
    per_bucket = stored(per_bucket, "mix-buckets")
    sizes = per_bucket.groupBy("source").agg(F.sum("words").alias("source_size"))
    planned = targets(sizes, mix).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    )
    planned = planned.withColumn("whole", F.coalesce("whole", F.lit(1)).cast("bigint"))
    planned = planned.withColumn(
        "rest", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")
    )
    planned = stored(planned, "mix-targets")

    along = Window.partitionBy("source").orderBy("bucket")
    upto = per_bucket.withColumn("upto", F.sum("words").over(along)).join(
        planned.select(F.col("source").alias("named"), "rest"),
        F.col("source").eqNullSafe(F.col("named")),
    )
    turn = (
        upto.where(F.col("upto") > F.col("rest"))
        .groupBy(F.col("named").alias("source"))
        .agg(F.min(F.struct("bucket", F.col("upto") - F.col("words"), "rest")).alias("turn"))
        .select(
            F.col("source").alias("named"),
            F.col("turn.bucket").alias("bucket"),
            F.col("turn.col2").alias("before"),
            F.col("turn.rest").alias("rest"),
        )
    )
    inside = narrow.join(
        turn, F.col("source").eqNullSafe(F.col("named")) & (bucket == F.col("bucket"))
    ).select("named", "bucket", "before", "rest", "order_key", "row", "size")
    return stored(
        planned.join(
            _last_taken(inside), F.col("source").eqNullSafe(F.col("named")), "left"
        ).select(
            F.col("source").alias("mixed_source"),
            "source_size",
            "target",
            "whole",
            F.coalesce("last_key", F.lit("")).alias("last_key"),
            F.coalesce("last_row", F.lit(-1)).alias("last_row"),
            F.coalesce("n_last", F.lit(0)).alias("n_last"),
            F.coalesce("n_equal", F.lit(0)).alias("n_equal"),
        ),
        "mix-cuts",
    )


def _last_taken(inside: DataFrame) -> DataFrame:
    """Per source, the key and row where its prefix ends, from the rows of the
    bucket it ends in; how many rows have that key and how many of them are taken."""
    order = ["order_key", "row"]
    ranges = inside.repartitionByRange("named", *order)
    dealt = stored(ranges.withColumn("part", F.spark_partition_id()), "mix-ranges")
    # one row per source and range: bounded by the partitions of a shuffle
    ahead = Window.partitionBy("named").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("named", "part")
        .agg(F.sum("size").alias("words"))
        .select(
            F.col("named").alias("of_source"),
            F.col("part").alias("of_part"),
            F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"),
        )
    )
    running = (
        Window.partitionBy("named", "part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("before") + F.col("ahead") + F.col("within")
    # without a rest nothing is taken once more, texts without words included
    reached = (F.col("rest") > 0) & (upto - F.col("size") / 2 <= F.col("rest"))
    last = (
        dealt.withColumn("within", F.sum("size").over(running))
        .join(
            offsets,
            F.col("named").eqNullSafe(F.col("of_source")) & (F.col("part") == F.col("of_part")),
        )
        .groupBy("named")
        .agg(
            F.max(F.when(reached, F.struct(*order))).alias("last"),
            F.when(F.max("rest") > 0, F.min("bucket")).alias("start"),
        )
        .select(
            F.col("named").alias("ended"),
            # an unreached bucket leaves the prefix in front of it
            F.coalesce("last.order_key", "start").alias("last_key"),
            F.coalesce("last.row", F.lit(-1)).alias("last_row"),
        )
    )
    equal = dealt.join(last, F.col("named").eqNullSafe(F.col("ended"))).groupBy(
        "named", "last_key", "last_row"
    )
    at_last = F.col("order_key") == F.col("last_key")
    return equal.agg(
        F.count_if(at_last & (F.col("row") <= F.col("last_row"))).alias("n_last"),
        F.count_if(at_last).alias("n_equal"),
    )


def _narrow(docs: DataFrame, mix: Mix) -> DataFrame:
    rows = docs.select(
        "doc_id",
        "source",
        n_words(F.col("text")).alias("size"),
        row_key(mix.seed).alias("order_key"),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken."""
    narrow = _narrow(docs, mix)
    cuts = _cuts(narrow, mix)
    extra = (F.col("order_key") < F.col("last_key")) | (
        (F.col("order_key") == F.col("last_key")) & (F.col("row") <= F.col("last_row"))
    )
    return narrow.join(cuts, F.col("source").eqNullSafe(F.col("mixed_source"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + extra.cast("bigint"))).alias("taken"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with their number per source from 1: counted per part as written,
    so that no source meets in one task."""
    rows = rows.withColumn("__mix_row", F.monotonically_increasing_id())
    rows = stored(rows, "mix-equal").withColumn("__mix_part", F.shiftright("__mix_row", 33))
    source, part = F.col("__mix_cut.mixed_source"), F.col("__mix_part")
    ahead = Window.partitionBy("__of").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(source.alias("__of"), part.alias("__at"))
        .agg(F.count("*").alias("__n"))
        .select("__of", "__at", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    )
    inside = F.row_number().over(Window.partitionBy(source, part).orderBy("__mix_row"))
    return (
        rows.withColumn("__inside", inside)
        .join(offsets, source.eqNullSafe(F.col("__of")) & (part == F.col("__at")))
        .withColumn("__mix_number", F.col("__ahead") + F.col("__inside"))
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan takes it."""
    cuts = _cuts(_narrow(docs, mix), mix)
    # a prefix that ends among equal rows takes some of them, which needs their numbers
    divided = not cuts.where("n_last < n_equal").isEmpty()
    cut = F.struct("whole", "last_key", "n_last", "mixed_source").alias("__mix_cut")
    rows = docs.join(
        cuts.select(cut), F.col("source").eqNullSafe(F.col("__mix_cut.mixed_source"))
    )
    key, last = row_key(mix.seed), F.col("__mix_cut.last_key")

    def repeated(rows: DataFrame, extra: Column) -> DataFrame:
        copies = (F.col("__mix_cut.whole") + extra.cast("bigint")).cast("int")
        many = rows.withColumn("__mix_copies", F.array_repeat(F.lit(1), copies))
        return many.select(
            *[F.col(c) for c in docs.columns], F.explode("__mix_copies").alias("__mix_copy")
        ).drop("__mix_copy")

    if not divided:
        return repeated(rows, key <= last)
    equal = _numbered(rows.where(key == last))
    return repeated(rows.where(key != last), key < last).union(
        repeated(equal, F.col("__mix_number") <= F.col("__mix_cut.n_last"))
    )
