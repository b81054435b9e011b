import os

import pytest

from punctual import session
from punctual.plans.flights import flights_from_lines, read_table


def test_scratch_is_removed_at_the_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [str(tmp_path / "kept")])
    path = str(tmp_path / "gone")
    spark.range(3).write.parquet(path)
    monkeypatch.setattr(session, "_SCRATCH", [path])
    session.remove_scratch()
    assert not os.path.exists(path) and session._SCRATCH == []


def test_a_shared_folder_is_needed(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_folder(spark, "x").startswith(f"{folder}/punctual-x-")

    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Bare)


def test_long_ids_stay_whole(spark, small):
    lines = read_table(spark, small, "lineitem").limit(4).selectExpr(
        "123456789L + l_linenumber AS l_orderkey", "l_partkey", "12345L AS l_suppkey",
        "l_linenumber", "l_extendedprice", "l_shipdate",
    )
    lines = lines.unionAll(lines.selectExpr("l_orderkey", "l_partkey", "12340L", "l_linenumber", "l_extendedprice", "l_shipdate"))
    rows = flights_from_lines(lines, read_table(spark, small, "part")).collect()
    assert {r.origin for r in rows} == {"S12345", "S12340"}
    assert all(r.flight_id.startswith("FL12345679") for r in rows)
    # the hub test by the last digit is the rule by the number
    assert {r.origin.endswith("0") for r in rows} == {True, False}
