"""The jobs chained as a user would run them."""

from punctual.jobs.cli import main, reports
from punctual.schema import SCORED_COLUMNS
from punctual.sources import files


def test_from_synthesis_to_prediction(spark, tmp_path, capfd):
    at = {n: str(tmp_path / n) for n in ("csv", "feed", "reports", "features", "trees", "progress", "out")}
    model = ["--features-path", at["features"], "--classifier-path", at["trees"]]

    main(["synthesise", "--output", at["csv"], "--records", "2000"], spark)
    flights = files.read_flights_csv(spark, at["csv"])
    assert flights.count() == 2000

    main(["report", "--input", at["csv"], "--output", at["reports"], "--min-flights", "5"], spark)
    for title in reports(flights):
        assert spark.read.parquet(f"{at['reports']}/{title.replace(' ', '_')}").count() > 0

    main(["train", "--input", at["csv"], "--trees", "2", "--depth", "2", *model], spark)
    assert "weighted_f1" in capfd.readouterr().out

    main(["feed", "--input", at["csv"], "--kind", "files", "--path", at["feed"]], spark)
    predict = ["predict", "--kind", "files", "--path", at["feed"], *model]
    predict += ["--sink", "parquet", "--output", at["out"], "--checkpoint", at["progress"], "--once"]
    main(predict, spark)
    scored = spark.read.parquet(at["out"])
    assert scored.columns == list(SCORED_COLUMNS) and scored.count() == 2000
