from pyspark.sql import functions as F

from punctual.llm import batches


def bodies(spark, n, size):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.expr(f"CAST(rpad(CAST(id AS STRING), {size}, 'x') AS BINARY)").alias("__body"),
    )


def test_buckets_follow_the_bytes(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    docs = bodies(spark, 100, 1000)
    assert batches.bucket_count(docs) == least
    assert batches.bucket_count(docs, 5000) == 20
    assert batches.bucket_count(docs, 5001) == 20
    assert batches.bucket_count(docs, 1) == min(100_000, most)
    assert batches.bucket_count(bodies(spark, 0, 10)) == least
    assert batches.bucket_count(docs.withColumn("__body", F.lit(None).cast("binary"))) == least


def test_more_buckets_than_partitions_are_joined_where_they_lie(spark):
    docs = bodies(spark, 200, 1000)
    table = batches.batched(docs, "test", batch_bytes=4000, bucket_bytes=10_000)
    answers = table.select("batch", "size")

    def count(batch, answer):
        import pyarrow as pa

        rows = batches.from_blob(batch.column("body")[0].as_py()).num_rows
        assert rows == answer.column("size")[0].as_py()
        return pa.table({"n": pa.array([rows], pa.int64())})

    joined = (
        table.groupBy("batch")
        .cogroup(answers.repartition(3).groupBy("batch"))
        .applyInArrow(count, "n long")
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "20 out of 20" in plan
    assert plan.count("Exchange hashpartitioning(batch") == 1
    assert joined.agg(F.sum("n")).first()[0] == 200
