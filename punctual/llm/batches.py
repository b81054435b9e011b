"""Rows in batches of a few megabytes, kept where counts can find them again.

Operators that ask "how often does this occur in the whole corpus" send sorted
keys of a batch to the partitions that count them and get the answers back per
batch. The batch itself stays put: it is one row of a table that is bucketed by
batch id, so that answers are joined to it without moving the texts again.

A bucket is one task wherever the table is read, and adaptive execution cannot
cut it. So the number of buckets follows the bytes of the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import regrouped
from punctual.session import scratch_folder

BATCH_BYTES = 8 << 20
BUCKET_BYTES = 256 << 20


def to_blob(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(out, table.schema, options=options) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the bodies of ``docs``: about ``bucket_bytes`` each, at least as
    many as a shuffle has partitions (with fewer, Spark would shuffle the table to
    join it), at most as many as a table may have."""
    setting = docs.sparkSession.conf.get
    total = docs.agg(F.sum(F.octet_length("__body").cast("long"))).first()[0] or 0
    wanted = max(int(setting("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    return min(wanted, int(setting("spark.sql.sources.bucketing.maxBuckets")))


def batched(
    docs: DataFrame,
    label: str,
    measure=None,
    batch_bytes: int = BATCH_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """A table (batch, kind, size, body): every row of ``docs`` in one batch.

    ``docs`` must have a binary column ``__body``. ``measure`` gets a batch's
    table and returns its size (default: rows). Batches never mix values of an
    optional integer column ``__kind``.
    """
    spark = docs.sparkSession
    kinds = "__kind" in docs.columns

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(rows, batch_bytes, "__body"):
            for kind in sorted(set(part.column("__kind").to_pylist())) if kinds else [0]:
                own = part
                if kinds:
                    own = part.filter(pa.compute.equal(part.column("__kind"), kind))
                own = own.combine_chunks()
                yield pa.RecordBatch.from_pydict(
                    {
                        "batch": [uuid.uuid4().hex],
                        "kind": pa.array([kind], pa.int32()),
                        "size": pa.array([measure(own) if measure else own.num_rows], pa.int64()),
                        "body": pa.array([to_blob(own)], pa.binary()),
                    }
                )

    import pyarrow.compute  # noqa: F401  (pa.compute)

    rows = docs.mapInArrow(run, "batch string, kind int, size long, body binary")
    name = f"batches_{uuid.uuid4().hex}"
    buckets = bucket_count(docs, bucket_bytes)
    writer = rows.write.option("path", scratch_folder(spark, label)).option("compression", "none")
    writer.bucketBy(buckets, "batch").saveAsTable(name)
    table = spark.table(name)
    # the catalog entry is only needed to learn the layout; the files stay
    spark.sql(f"DROP TABLE {name}")
    return table.where(F.col("batch").isNotNull())
