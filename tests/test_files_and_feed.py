import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from punctual.plans.flights import flights_table
from punctual.schema import COLUMNS
from punctual.session import ensure_checkpoint_dir, scratch_folder, shared_folder
from punctual.settings import Settings
from punctual.sources import feed, files
from punctual.streaming import scoring


def _csv(tmp_path, text, name="f.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_columns_go_by_name_and_may_be_missing(spark, tmp_path):
    path = _csv(tmp_path, "is_delayed,scheduled_departure,date,extra\n1,06:15,2022-01-02,z\nx,,,\n")
    df = files.read_flights_csv(spark, path)
    assert dict(df.dtypes) == {
        "is_delayed": "double", "scheduled_departure": "string", "date": "string", "extra": "string"
    }
    assert [tuple(r) for r in df.collect()] == [(1.0, "06:15", "2022-01-02", "z"), (None, None, None, None)]


def test_quotes_and_blanks_survive(spark, tmp_path):
    rows = spark.createDataFrame([(' a "b", c ', 1.5)], "origin string, distance_miles double")
    out = str(tmp_path / "out")
    files.write_flights_csv(rows, out)
    assert files.read_flights_csv(spark, out).first() == rows.first()


def test_files_with_other_headers_are_refused(spark, tmp_path):
    _csv(tmp_path, "origin,date\nA,2022-01-01\n", "a.csv")
    _csv(tmp_path, "date,origin\n2022-01-01,A\n", "b.csv")
    with pytest.raises(Exception, match="header"):
        files.read_flights_csv(spark, str(tmp_path)).collect()


def test_feed_reads_text_and_keeps_empty_fields(spark, tmp_path):
    path = _csv(tmp_path, "flight_id,origin,distance_miles\nF1,,12\nF2,ATL,\n")
    rows = files.read_feed_csv(spark, path)
    records = feed.keyed_records(rows).collect()
    assert [r.key for r in records] == [None, "ATL"]
    assert json.loads(records[0].value) == {"flight_id": "F1", "origin": "", "distance_miles": "12"}
    assert json.loads(records[1].value)["distance_miles"] == ""


def test_key_without_origin_column(spark):
    assert feed.keyed_records(spark.createDataFrame([("F1",)], "flight_id string")).first().key == "UNKNOWN"


@pytest.mark.parametrize("most, sent", [(None, 5), (0, 5), (3, 3), (9, 5)])
def test_record_cap(spark, most, sent):
    assert feed.keyed_records(spark.range(5), most).count() == sent


def test_broker_options():
    settings = Settings(servers="a:1,b:2", topic="t")
    assert feed.kafka_source_options(settings) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    tuned = feed.kafka_source_options(settings, max_offsets_per_trigger=500, min_partitions=64)
    assert tuned["maxOffsetsPerTrigger"] == "500" and tuned["minPartitions"] == "64"
    assert feed.kafka_sink_options(settings) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "topic": "t",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
    }


def test_pace():
    assert feed.records_per_trigger(5) == 5000
    assert feed.records_per_trigger(0.1, batch_size=7) == 7


def test_unknown_kinds(spark, tmp_path):
    records = spark.createDataFrame([("k", "v")], feed.RECORD_SCHEMA)
    with pytest.raises(ValueError):
        feed.read_records(spark, "other")
    with pytest.raises(ValueError):
        feed.send_records(records, "other")


def test_broker_source_is_the_spark_connector(spark):
    # no broker and no connector jar here: Spark must name the missing source
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        feed.read_records(spark, "kafka")


def test_parquet_by_carrier(spark, small, tmp_path):
    flights = flights_table(spark, small)
    out = str(tmp_path / "flights")
    files.write_flights_parquet(flights, out, partition_by=("carrier",))
    back = files.read_flights_parquet(spark, out).select(*COLUMNS)
    assert back.exceptAll(flights).isEmpty() and back.count() == flights.count()
    plan = back.where("carrier = 'Brand#11'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(carrier" in plan


class _Session:
    """Just enough of a session on a cluster."""

    def __init__(self, **conf):
        self.conf = SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default))
        self.sparkContext = SimpleNamespace(master="yarn")


def test_folder_comes_from_the_session():
    session = _Session(spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(session) == "hdfs:///shared"
    assert scratch_folder(session, "x").startswith("hdfs:///shared/punctual-x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session())


def test_checkpoint_dir_is_kept(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert first and spark.sparkContext.getCheckpointDir() == first


# ---- streaming -----------------------------------------------------------------


def _records(spark, values):
    return spark.createDataFrame([("k", v) for v in values], feed.RECORD_SCHEMA)


def test_parse_takes_numbers_with_and_without_quotes(spark):
    values = [
        '{"distance_miles": "12", "flight_id": "F1"}',
        '{"distance_miles": 12}',
        '{"distance_miles": "x"}',
        "not json",
        None,
    ]
    parsed = scoring.parse_records(_records(spark, values))
    assert parsed.columns == list(COLUMNS)
    rows = parsed.collect()
    assert [r.distance_miles for r in rows] == [12.0, 12.0, None, None, None]
    assert rows[0].flight_id == "F1" and all(v is None for v in rows[3]) and all(v is None for v in rows[4])


def _run(spark, source, checkpoint, out, **limits):
    records = feed.read_records(spark, "files", source, **limits)
    query = scoring.write_stream(
        scoring.parse_records(records).select("flight_id"), checkpoint, "parquet", out, once=True
    )
    scoring.run(query)
    return query


def test_resume_and_pace(spark, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "progress", "out"))

    def send(first, last):
        rows = spark.range(first, last).selectExpr("CAST(id AS STRING) AS flight_id", "'A' AS origin")
        feed.send_records(feed.keyed_records(rows).repartition(4), "files", source)

    send(0, 100)
    query = _run(spark, source, checkpoint, out, max_files_per_trigger=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(out).count() == 100
    send(100, 250)
    _run(spark, source, checkpoint, out)
    _run(spark, source, checkpoint, out)
    got = spark.read.parquet(out)
    assert got.count() == 250 and got.distinct().count() == 250


def test_console_sink_and_interval(spark, tmp_path):
    source = str(tmp_path / "in")
    feed.send_records(_records(spark, ['{"flight_id": "F1"}']), "files", source)
    records = feed.read_records(spark, "files", source)
    query = scoring.write_stream(records, str(tmp_path / "progress"), interval="1 second")
    try:
        query.processAllAvailable()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    finally:
        query.stop()
    with pytest.raises(ValueError):
        scoring.write_stream(records, str(tmp_path / "p2"), "other")


def test_paced_feed_from_csv(spark, small, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("csv", "progress", "out"))
    flights = flights_table(spark, small).limit(90)
    files.write_flights_csv(flights.repartition(3), source)
    rows = files.stream_feed_csv(spark, source, max_files_per_trigger=1)
    query = scoring.write_stream(feed.keyed_records(rows), checkpoint, "parquet", out, once=True)
    scoring.run(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    back = scoring.parse_records(spark.read.parquet(out))
    assert back.count() == 90 and back.exceptAll(flights_table(spark, small)).isEmpty()


@pytest.mark.parametrize("names", [("a", "b", "c"), ("c", "a", "b"), ("b", "c", "a")])
def test_cap_takes_the_first_rows_of_the_files(spark, tmp_path, names):
    # written in another order than the names', sizes apart: tasks read large ones first
    start = 0
    for name, size in sorted(zip(names, (100, 5000, 200))):
        lines = [f"F{start + i:06d},x{i}" for i in range(size)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["flight_id,origin", *lines]) + "\n")
        start += size
    for files_a_task in ("128m", "1k", "16k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", files_a_task)
        try:
            rows = files.read_feed_csv(spark, str(tmp_path))
            for most in (1, 50, 150, 5100, 9999):
                got = sorted(r.flight_id for r in feed.capped(rows, most).collect())
                assert got == [f"F{i:06d}" for i in range(min(most, start))]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cap_of_rows_without_files(spark):
    rows = spark.range(100, numPartitions=5).withColumn("a", F.lit(1))
    assert sorted(r.id for r in feed.capped(rows, 37).collect()) == list(range(37))
    assert feed.capped(rows.limit(0), 5).count() == 0


def test_rejected_messages(spark):
    good = '{"flight_id": "F1", "distance_miles": 12, "extra": [1]}'
    texts = [good, "no json", '{"flight_id": "F2"', "[1, 2]", '"text"', "7", "null", "", None, "  {}"]
    records = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, value string")
    got = scoring.checked_records(records).collect()
    assert [r.rejected for r in got] == [False] + [True] * 8 + [False]
    assert [r.rejected_value for r in got] == [None, *texts[1:9], None]
    assert got[0].flight_id == "F1" and got[0].distance_miles == 12.0


def test_a_replayed_batch_is_written_once(spark, tmp_path):
    ledger = scoring.Ledger(spark, str(tmp_path / "out"))
    rows = spark.range(5)
    # rows of a batch that was never entered do not count
    rows.write.parquet(ledger._data(0, "rows"))
    ledger.write({"rows": spark.range(3)}, 0)
    ledger.write({"rows": rows}, 0)
    ledger.write({"rows": spark.range(3, 6)}, 1)
    spark.range(9).write.parquet(ledger._data(2, "rows"))
    assert sorted(r.id for r in ledger.read().collect()) == [0, 1, 2, 3, 4, 5]


def test_cap_moves_no_row(spark, tmp_path):
    """The counts per split are shuffled, the rows are not, whatever Spark knows of sizes."""
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(4).write.parquet(path)
    capped = feed.capped(spark.read.parquet(path), 700)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert capped.count() == 700


def test_file_twin_is_read_by_many_tasks(spark, tmp_path):
    """A file of the feed has row groups that several tasks can share."""
    import pyarrow.parquet as pq

    path = tmp_path / "feed"
    value = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(8)])
    rows = spark.range(30_000).select(F.lit("k").alias("key"), value.alias("value")).coalesce(1)
    feed.send_records(rows, "files", str(path))
    (file,) = path.glob("*.parquet")
    found = pq.ParquetFile(file)
    assert found.metadata.num_row_groups > 1 and found.metadata.num_rows == 30_000
    assert found.metadata.row_group(0).column(1).compression == "ZSTD"
