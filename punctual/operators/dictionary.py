"""Category dictionaries as tables: most frequent value first, index from 0.

For columns with so many values that a list of labels no longer fits the driver
and every task. Values are counted in one pass over all columns, range-partitioned
by (column, falling count, value) and numbered by the offset of their range plus
their place in it; the offsets are one row per range. Rows are encoded by a join,
where adaptive execution splits a value that holds much of the data.

Indices equal those of Spark ML's indexer by falling frequency; ties are broken by
the bytes of the value. A missing value is no entry. A value that is missing or
not in the dictionary gets the number of entries of its column as its index.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.session import scratch_folder


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` in the shared folder: ranges must not move between two passes."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``category, value, n`` of all known values of text columns, in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("category"), F.col(f"`{c}`").alias("value")) for c in columns]
    )
    # tasks reduce their rows to one per value before anything is shuffled
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("category", "value")
        .agg(F.count("*").alias("n"))
    )


def ranked(counts: DataFrame, order: Sequence, within: str) -> DataFrame:
    """``counts`` with ``index`` from 0 per value of ``within``, by ``order``."""
    keys = [F.col(within), *order]
    dealt = counts.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    dealt = _kept(dealt, "dictionary-ranges")
    # one row per range and column: how many entries of the column lie ahead
    ahead = Window.partitionBy(within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(within, "part")
        .agg(F.count("*").alias("held"))
        .select(
            F.col(within).alias("of"),
            F.col("part").alias("of_part"),
            F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("before"),
        )
    )
    place = F.row_number().over(Window.partitionBy(within, "part").orderBy(*order))
    return (
        dealt.withColumn("place", place)
        .join(offsets, (F.col(within) == F.col("of")) & (F.col("part") == F.col("of_part")))
        .withColumn("index", (F.col("before") + F.col("place") - 1).cast("bigint"))
        .drop("of", "of_part", "before", "place", "part")
    )


def dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``category, value, n, index`` of all known values, written once."""
    order = [F.desc("n"), F.asc("value")]
    return _kept(ranked(value_counts(df, columns), order, "category"), "dictionary")


def sizes(entries: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Entries per column: one number each, whatever their number."""
    found = {r.category: r.n for r in entries.groupBy("category").agg(F.count("*").alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def encode(df: DataFrame, entries: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_index``: 0 for the most frequent value; unseen and
    missing values get the number of entries."""
    number = sizes(entries, columns)
    for c in columns:
        own = entries.where(F.col("category") == c).select(
            F.col("value").alias("__value"), F.col("index").alias("__index")
        )
        joined = df.join(own, F.col(f"`{c}`") == F.col("__value"), "left")
        index = F.coalesce("__index", F.lit(number[c])).cast("double")
        df = joined.withColumn(f"{c}_index", index).drop("__value", "__index")
    return df


def distinct_bitmaps(
    df: DataFrame, entries: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``by``, ``category``, ``bucket``, ``bitmap``: which dictionary entries occur in
    each group, a bit for each, in buckets of a fixed number of bits.

    Bitmaps of days or files can be kept and merged later; rows are not looked at
    again, and neither multiplied per column nor per distinct value.
    """
    parts = []
    for c in columns:
        bit = F.col(f"{c}_index").cast("bigint") + 1
        known = encode(df.select(*{*by, c}), entries, [c]).where(F.col(f"`{c}`").isNotNull())
        parts.append(
            known.groupBy(
                *by, F.lit(c).alias("category"), F.bitmap_bucket_number(bit).alias("bucket")
            ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap"))
        )
    return reduce(DataFrame.unionAll, parts)


def merged_distinct(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact number of distinct values per column over all merged bitmaps."""
    merged = bitmaps.groupBy(*by, "category", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by, "category").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
