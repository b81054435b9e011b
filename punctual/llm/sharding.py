"""Proportional stratified interleaving into shards.

The rows of each source are shuffled by a seeded key and spread evenly over
[0, 1): row ``r`` of ``n`` stands at ``(r + u) / n``, where ``u`` is a fixed
fraction of the source, so that small sources do not all meet in the middle.
Sorted by that place, every stretch of the sequence holds the sources in the
proportion of the whole. It is cut into shards whose row counts differ by one at
most; a row's slot is its place in the shard.

Both ranks are exact without a global sort: rows fall into buckets by the first
digits of the key (within a source) and by place, only bucket totals are summed
up over all buckets, and rows are numbered within a bucket. A source with a
third of all rows is thus spread over ``16 ** bucket_digits`` groups.

Edge cases: NULL is a source like others; NULL or empty texts weigh one byte and
have checksum 0; repeated rows are placed one behind the other; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import seeded_key, stored


def _row_key(seed: int) -> Column:
    """Shuffles rows by id and text, so that rows of one id are spread as well."""
    text = F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    return F.md5(F.concat(seeded_key(seed, F.col("doc_id")), text))


def place_rows(
    docs: DataFrame, seed: int = 17, bucket_digits: int = 3, place_buckets: int = 4096
) -> DataFrame:
    """``doc_id, source, size, text_crc32`` and the row's global position from 0."""
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = stored(
        docs.select(
            "doc_id",
            "source",
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            _row_key(seed).alias("order_key"),
        ).withColumn("bucket", F.substring("order_key", 1, bucket_digits)),
        "shard-rows",
    )
    per_bucket = narrow.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    of_source = Window.partitionBy("source")
    earlier = of_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col("source").alias("named"),
        F.col("bucket").alias("at"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(of_source).alias("n_source"),
    )
    # as stored tables both sides of the join are plain exchanges, which
    # adaptive execution may split where a bucket is large
    offsets = stored(offsets, "shard-offsets")
    inside = Window.partitionBy("source", "bucket").orderBy(
        "order_key", "doc_id", "size", "text_crc32"
    )
    ranked = narrow.withColumn("inside", F.row_number().over(inside)).join(
        # their number grows with the sources, so they are not broadcast
        offsets.hint("merge"),
        F.col("source").eqNullSafe(F.col("named")) & (F.col("bucket") == F.col("at")),
    )
    shift = F.conv(F.substring(seeded_key(seed, F.col("source")), 1, 8), 16, 10).cast("double")
    rank = (F.col("before") + F.col("inside") - 1).cast("double")
    placed = ranked.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        "order_key",
        ((rank + shift / 2.0**32) / F.col("n_source")).alias("place"),
    )
    slice_of = F.floor(F.col("place") * place_buckets)
    placed = stored(placed.withColumn("slice", slice_of), "shard-places")
    per_slice = placed.groupBy("slice").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        per_slice.select(
            F.col("slice").alias("of_slice"),
            F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
            F.sum("n").over(Window.partitionBy()).alias("n_rows"),
        ),
        "shard-starts",
    )
    within = Window.partitionBy("slice").orderBy(
        "place", "source", "order_key", "doc_id", "size", "text_crc32"
    )
    return (
        placed.withColumn("within", F.row_number().over(within))
        .join(starts, F.col("slice") == F.col("of_slice"))
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            (F.col("ahead") + F.col("within") - 1).alias("position"),
            "n_rows",
        )
    )


def shard_rows(docs: DataFrame, shards: int = 8, **knobs) -> DataFrame:
    """Shard and slot of every row; counts per shard differ by one at most."""
    exact = F.expr(f"position * {shards} div n_rows")
    first = F.expr(f"(shard * n_rows + {shards - 1}) div {shards}")
    return (
        place_rows(docs, **knobs)
        .withColumn("shard", exact)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("position") - first).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
