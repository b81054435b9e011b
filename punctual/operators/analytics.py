"""Descriptive reports over flights. Each is one or two aggregations whose
partial results are combined before any shuffle, so hot keys cost nothing extra.

Missing keys and labels (NULL or NaN) are left out, as data frames in Python do.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.parsing import clock_part, present
from punctual.schema import LABEL, NUMERIC_COLUMNS


def dataset_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Row count, label balance and percent delayed, in one pass."""
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == 1).alias("delayed"),
        F.count_if(F.col(label) == 0).alias("not_delayed"),
    )
    labelled = (F.col("delayed") + F.col("not_delayed")).cast("double")
    percent = F.try_divide(F.col("delayed") * F.lit(100.0), labelled)
    return counts.withColumn("percent_delayed", percent)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Relative frequency of each value, most frequent first."""
    counts = _known(df, column).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per column, duplicates removed inside
    the map tasks before anything is shuffled."""
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def overall_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(present(F.col(label))).alias("delay_rate"))


def _known(df: DataFrame, column: str) -> DataFrame:
    # the plain test first: it reaches the files, the one for NaN does not
    df = df.where(F.col(column).isNotNull())
    return df.where(~F.isnan(column)) if dict(df.dtypes)[column] == "double" else df


def rate_by(df: DataFrame, key: str, label: str = LABEL, by_key: bool = False) -> DataFrame:
    """Mean of the label per key: highest first, or in key order."""
    rates = _known(df, key).groupBy(key).agg(F.avg(present(F.col(label))).alias("delay_rate"))
    return rates.orderBy(key) if by_key else rates.orderBy(F.desc("delay_rate"), key)


def rate_by_hour(df: DataFrame, label: str = LABEL) -> DataFrame:
    hour = clock_part(F.col("scheduled_departure"), 0)
    return rate_by(df.withColumn("dep_hour", hour), "dep_hour", label, by_key=True)


def origin_stats(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Flights and delay rate per origin."""
    return (
        _known(df, "origin")
        .groupBy("origin")
        .agg(
            F.count("flight_id").alias("total_flights"),
            F.avg(present(F.col(label))).alias("delay_rate"),
        )
    )


def top_origins(df: DataFrame, min_flights: int = 500, n: int = 20) -> DataFrame:
    """Origins with the highest delay rate among those busy enough; equal rates
    rank by name, origins without any label last."""
    busy = origin_stats(df).where(F.col("total_flights") >= min_flights)
    return busy.orderBy(F.desc("delay_rate"), "origin").limit(n)


def rate_uplift(
    df: DataFrame, when: Column, against: Column | None = None, label: str = LABEL
) -> DataFrame:
    """Delay rate where ``when`` holds, where ``against`` holds (default: where
    ``when`` does not), and the difference."""
    value = present(F.col(label))
    rates = df.agg(
        F.avg(F.when(when, value)).alias("rate_when"),
        F.avg(F.when(~when if against is None else against, value)).alias("rate_against"),
    )
    return rates.withColumn("uplift", F.col("rate_when") - F.col("rate_against"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are known.

    One pass groups rows by which columns are known (a bit mask: one group when
    nothing is missing, at most 2^k for k columns) and keeps means and
    covariances, which stay accurate for large values. The few group rows are
    merged per pair: covariances add up, with the products of how far each
    group's means lie from those of the pair. A constant column has no
    correlation: NULL.
    """
    known = df.select([present(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)])
    size = range(len(columns))
    pairs = list(combinations_with_replacement(size, 2))

    mask = " + ".join(f"IF(x{i} IS NULL, 0, {1 << i})" for i in size)
    moments = ["CAST(COUNT(*) AS DOUBLE) AS n"]
    for i in size:
        moments += [f"AVG(x{i}) AS m{i}", f"MIN(x{i}) AS low{i}", f"MAX(x{i}) AS high{i}"]
    moments += [f"COVAR_POP(x{i}, x{j}) AS c{i}_{j}" for i, j in pairs]
    groups = known.groupBy(F.expr(mask).alias("mask")).agg(*map(F.expr, moments))

    entries = ", ".join(
        f"STRUCT({i} AS i, {j} AS j, {1 << i | 1 << j} AS needs, mask, n, m{i} AS mx, m{j} AS my,"
        f" c{i}_{i} AS cxx, c{j}_{j} AS cyy, c{i}_{j} AS cxy,"
        f" low{i} AS low_x, high{i} AS high_x, low{j} AS low_y, high{j} AS high_y)"
        for i, j in pairs
    )
    pair = Window.partitionBy("i", "j")
    met = (
        groups.selectExpr(f"INLINE(ARRAY({entries}))")
        .where("mask & needs = needs")
        .withColumns(
            {
                "dx": F.col("mx") - F.sum(F.expr("n * mx")).over(pair) / F.sum("n").over(pair),
                "dy": F.col("my") - F.sum(F.expr("n * my")).over(pair) / F.sum("n").over(pair),
            }
        )
    )
    totals = met.groupBy("i", "j").agg(
        F.expr("SUM(n * (cxx + dx * dx)) AS sxx"),
        F.expr("SUM(n * (cyy + dy * dy)) AS syy"),
        F.expr("SUM(n * (cxy + dx * dy)) AS sxy"),
        F.expr("MIN(low_x) < MAX(high_x) AND MIN(low_y) < MAX(high_y)").alias("varies"),
    )
    values = totals.selectExpr(
        "i",
        "j",
        "CASE WHEN NOT varies THEN NULL WHEN i = j THEN 1.0D"
        " ELSE TRY_DIVIDE(sxy, SQRT(sxx) * SQRT(syy)) END AS r",
    )
    # every pair is listed, also one without a row in common
    listed = ", ".join(f"STRUCT({i} AS i, {j} AS j)" for i, j in pairs)
    wanted = df.sparkSession.range(1).selectExpr(f"INLINE(ARRAY({listed}))")
    names = ", ".join(f"'{c}'" for c in columns)
    return wanted.join(values, ["i", "j"], "left").selectExpr(
        f"INLINE(ARRAY_DISTINCT(TRANSFORM(ARRAY(STRUCT(i AS a, j AS b), STRUCT(j AS a, i AS b)),"
        f" p -> STRUCT(GET(ARRAY({names}), p.a) AS feature_a, GET(ARRAY({names}), p.b) AS feature_b,"
        f" IF(r IS NULL, NULL, LEAST(1.0D, GREATEST(-1.0D, r))) AS correlation))))"
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the least and the greatest value: bin number,
    its edges and its count, empty bins included, last bin closed.

    A value belongs to the bin whose stored edges enclose it, also where
    rounding would put the quotient on the other side of an edge. A single
    value gets the range half a unit to each side; no value at all, 0 to 1.
    """
    values = df.select(present(F.col(column).cast("double")).alias("x")).where("x IS NOT NULL")
    limits = values.agg(
        F.coalesce(F.min("x"), F.lit(0.0)).alias("least"),
        F.coalesce(F.max("x"), F.lit(1.0)).alias("greatest"),
    )
    margin = F.when(F.col("least") == F.col("greatest"), 0.5).otherwise(0.0)
    limits = limits.select(
        (F.col("least") - margin).alias("lo"), (F.col("greatest") + margin).alias("hi")
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    inner = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.col("lo") + i.cast("double") * step
    )
    edges = limits.select(
        F.struct("lo", "hi", F.concat(inner, F.array("hi")).alias("edges")).alias("r")
    )

    # The range is a one-row subquery: it runs once and enters the plan as a
    # constant, so the counting pass is a plain partial aggregation.
    ranged = values.withColumn("r", edges.scalar())
    guess = F.least(
        F.width_bucket("x", "r.lo", "r.hi", F.lit(bins)) - 1, F.lit(bins - 1)
    ).cast("int")
    located = ranged.withColumn("guess", guess)
    left, right = F.get("r.edges", F.col("guess")), F.get("r.edges", F.col("guess") + 1)
    settled = (
        F.when(F.col("x") < left, F.col("guess") - 1)
        .when((F.col("x") >= right) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = located.groupBy(settled.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = edges.select(
        F.posexplode(F.slice("r.edges", 1, bins)).alias("bin", "left_edge"), "r"
    ).select("bin", "left_edge", F.get("r.edges", F.col("bin") + 1).alias("right_edge"))
    return (
        all_bins.join(counted, "bin", "left")
        .select("bin", "left_edge", "right_edge", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("bin")
    )
