"""ANSI SQL stating what each registered query must return.

Written apart from the Spark code and run by another engine on the same
tables. Of trained models it states what any of them must fulfil.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from punctual.schema import CATEGORICAL_FEATURES, COLUMNS, NUMERIC_COLUMNS, NUMERIC_FEATURES

_WEATHER = """CASE WHEN {p} < 40 THEN 'Clear' WHEN {p} < 65 THEN 'Cloudy' WHEN {p} < 80 THEN 'Rain'
 WHEN {p} < 88 THEN 'Snow' WHEN {p} < 95 THEN 'Fog' ELSE 'Thunderstorm' END"""


def _weather(percent: str) -> str:
    return _WEATHER.format(p=percent)


_PROBABILITY = """120
 + CASE WHEN {w} IN ('Rain', 'Thunderstorm') THEN 250 WHEN {w} IN ('Snow', 'Fog') THEN 200 ELSE 0 END
 + CASE WHEN {h} BETWEEN 6 AND 9 OR {h} BETWEEN 16 AND 20 THEN 80 ELSE 0 END
 + CASE WHEN {hub} THEN 50 ELSE 0 END"""

_LINES = f"""
keyed AS (
  SELECT *, (l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709 + l_linenumber*15485863
             + CAST(ROUND(l_extendedprice*100) AS BIGINT)*31) % 1000003 AS h
  FROM lineitem),
drawn AS (
  SELECT *,
    (h*48271) % 2147483647 AS h1, (h*69621+12345) % 2147483647 AS h2,
    (h*16807+777) % 2147483647 AS h3, (h*39373+99) % 2147483647 AS h4,
    (h*40692+7) % 2147483399 AS h5, (h*62089911+3) % 2147483647 AS h6,
    (h*742938285+11) % 2147483647 AS h7, (h*950706376+17) % 2147483647 AS h8
  FROM keyed),
shaped AS (
  SELECT *, 5 + h1 % 19 AS hr, 15*(h2 % 4) AS mi,
    {_weather('h3 % 100')} AS w_from,
    {_weather('h6 % 100')} AS w_to
  FROM drawn),
likely AS (
  SELECT *, {_PROBABILITY.format(w='w_from', h='hr', hub='l_suppkey % 10 = 0')} AS prob_milli
  FROM shaped),
lines AS (
  SELECT *, CASE WHEN h4 % 1000 >= prob_milli THEN 0
                 WHEN h5 % 1000 < 500 THEN 15 + h2 % 31
                 WHEN h5 % 1000 < 800 THEN 46 + h2 % 75
                 ELSE 121 + h2 % 240 END AS dd
  FROM likely)"""


def _s(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR(30))"


def _two(expression: str) -> str:
    return f"LPAD({_s(expression)}, 2, '0')"


def _padded(expression: str, width: int) -> str:
    """Zero-padded; longer numbers keep all their digits."""
    text = _s(expression)
    return f"LPAD({text}, CAST(GREATEST({width}, LENGTH({text})) AS INTEGER), '0')"


def _clock(minutes: str) -> str:
    hour = f"CAST(FLOOR((({minutes}) % 1440)/60) AS BIGINT)"
    return f"CONCAT({_two(hour)}, ':', {_two(f'({minutes}) % 60')})"


_FLIGHTS = f"""{_LINES},
flights AS (
  SELECT
    CONCAT('FL', {_padded('l_orderkey', 7)}, '-', {_s('l_linenumber')}, '-',
           {_s('l_partkey')}, '-', {_s('l_suppkey')}) AS flight_id,
    SUBSTR({_s('l_shipdate')},1,10) AS date,
    p_brand AS carrier,
    CONCAT(p_brand, '-', {_s('100 + h5 % 9900')}) AS flight_number,
    CONCAT('S', {_padded('l_suppkey', 4)}) AS origin,
    CONCAT('S', {_padded('(l_suppkey + 1 + h3 % 97) % 100', 4)}) AS destination,
    CONCAT({_two('hr')}, ':', {_two('mi')}) AS scheduled_departure,
    {_clock('hr*60 + mi + 60 + h7 % 361')} AS scheduled_arrival,
    CAST(100 + h5 % 3901 AS DOUBLE) AS distance_miles,
    w_from AS weather_origin, w_to AS weather_destination,
    CAST(h7 % 1200 AS DOUBLE)/CAST(10 AS DOUBLE) AS temperature_origin,
    CAST(h8 % 300 AS DOUBLE)/CAST(10 AS DOUBLE) AS wind_speed_origin,
    CAST(5 + h8 % 31 AS DOUBLE) AS taxi_out_minutes,
    CAST(3 + h1 % 20 AS DOUBLE) AS taxi_in_minutes,
    CAST(dd AS DOUBLE) AS departure_delay_minutes,
    CAST(GREATEST(0, dd + h6 % 26 - 10) AS DOUBLE) AS arrival_delay_minutes,
    CAST(CASE WHEN dd >= 15 THEN 1 ELSE 0 END AS DOUBLE) AS is_delayed
  FROM lines JOIN part ON p_partkey = l_partkey)"""

_HOUR = "CAST(SPLIT_PART(scheduled_departure, ':', 1) AS INTEGER)"
_MINUTE = "CAST(SPLIT_PART(scheduled_departure, ':', 2) AS INTEGER)"
_HUB = "origin LIKE '%0'"
_RULE = _PROBABILITY.format(w="weather_origin", h=_HOUR, hub=_HUB)
_BUCKET = "CAST(CONCAT('0x', SUBSTR(MD5(flight_id), 1, 8)) AS BIGINT) % 100"
_LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _flights(body: str) -> str:
    """A query over the flight table; a body may go on with its own CTEs."""
    joint = "," if body.startswith("+") else ""
    return f"WITH {_FLIGHTS}{joint}\n{body.removeprefix('+')}"


def _lines(body: str) -> str:
    return f"WITH {_LINES}\n{body}"


_SCORED = f"""+ scored AS (
  SELECT flight_id, weather_origin, is_delayed, CAST({_RULE} AS DOUBLE)/1000.0 AS score,
    CAST(CASE WHEN ({_RULE}) >= 300 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM flights)"""


def _scored(body: str) -> str:
    return _flights(f"{_SCORED}{',' if body.startswith('+') else ''}\n{body.removeprefix('+')}")


_SHARE = """SELECT {c}, COUNT(*) AS n, COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share
FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"""


def _rate(key: str, column: str) -> str:
    return _flights(
        f"SELECT {key} AS {column}, AVG(is_delayed) AS delay_rate FROM flights GROUP BY 1"
    )


def _uplift(when: str, against: str) -> str:
    return _flights(f"""SELECT AVG(CASE WHEN {when} THEN is_delayed END) AS rate_when,
  AVG(CASE WHEN {against} THEN is_delayed END) AS rate_against,
  AVG(CASE WHEN {when} THEN is_delayed END) - AVG(CASE WHEN {against} THEN is_delayed END) AS uplift
FROM flights""")


def _histogram(column: str) -> str:
    return _flights(f"""+ v AS (SELECT {column} AS x FROM flights WHERE is_delayed = 1),
r AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
bins AS (
  SELECT CAST(i AS INTEGER) AS bin,
    lo + CAST(i AS DOUBLE) * ((hi - lo) / 50.0) AS left_edge,
    CASE WHEN i = 49 THEN hi ELSE lo + CAST(i + 1 AS DOUBLE) * ((hi - lo) / 50.0) END AS right_edge
  FROM r, RANGE(50) AS s(i))
SELECT bin, left_edge, right_edge, COUNT(x) AS n
FROM bins LEFT JOIN v ON x >= left_edge AND (x < right_edge OR (bin = 49 AND x = right_edge))
GROUP BY 1, 2, 3""")


def _correlations() -> str:
    parts = []
    for a, b in combinations_with_replacement(NUMERIC_COLUMNS, 2):
        for left, right in {(a, b), (b, a)}:
            parts.append(
                f"SELECT '{left}' AS feature_a, '{right}' AS feature_b, "
                f"ROUND(CORR({a}, {b}), 6) AS correlation FROM flights"
            )
    # the flight table is scanned once, not once per pair
    body = "\nUNION ALL ".join(parts)
    return _flights(body).replace("flights AS (", "flights AS MATERIALIZED (", 1)


def _by_category(select: str, source: str) -> str:
    parts = [
        f"SELECT '{c}' AS category, {c} AS value, COUNT(*) AS n FROM {source} GROUP BY {c}"
        for c in CATEGORICAL_FEATURES
    ]
    return _flights(f"+ freq AS ({' UNION ALL '.join(parts)})\n{select}")


_POSITION = "ROW_NUMBER() OVER (PARTITION BY category ORDER BY n DESC, value) - 1"

_NUMERIC_FEATURES = {
    "scheduled_departure_hour": f"{_HOUR} AS scheduled_departure_hour",
    "scheduled_departure_minute": f"{_MINUTE} AS scheduled_departure_minute",
    "day_of_week": "CAST(DAYOFWEEK(CAST(date AS DATE)) + 1 AS INTEGER) AS day_of_week",
    "month": "CAST(MONTH(CAST(date AS DATE)) AS INTEGER) AS month",
}
_FEATURES = ", ".join(_NUMERIC_FEATURES.get(c, c) for c in NUMERIC_FEATURES)


_PASSED = "flight_id, carrier, origin, destination, scheduled_departure, weather_origin"

_SPLIT = "SELECT COUNT(DISTINCT flight_id) AS n, 0::BIGINT AS n_on_both, TRUE AS share_holds FROM flights"


_METRICS = """+ classes AS (SELECT DISTINCT is_delayed AS c FROM scored),
per_class AS (
  SELECT c,
    CAST(SUM(CASE WHEN is_delayed = c THEN 1 ELSE 0 END) AS DOUBLE) AS support,
    CAST(SUM(CASE WHEN prediction = c THEN 1 ELSE 0 END) AS DOUBLE) AS predicted,
    CAST(SUM(CASE WHEN is_delayed = c AND prediction = c THEN 1 ELSE 0 END) AS DOUBLE) AS hits
  FROM scored, classes GROUP BY c),
rated AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p, hits / support AS r
  FROM per_class)
SELECT ROUND(SUM(hits) / SUM(support), 9) AS accuracy,
  ROUND(SUM(p * support) / SUM(support), 9) AS weighted_precision,
  ROUND(SUM(r * support) / SUM(support), 9) AS weighted_recall,
  ROUND(SUM(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * support) / SUM(support), 9)
    AS weighted_f1
FROM rated"""

_AUC = """+ levels AS (
  SELECT score, CAST(SUM(is_delayed) AS DOUBLE) AS p, CAST(SUM(1 - is_delayed) AS DOUBLE) AS n
  FROM scored GROUP BY score),
ordered AS (SELECT *, SUM(n) OVER (ORDER BY score) - n AS below FROM levels)
SELECT ROUND(SUM(p * (below + n / 2)) / (SUM(p) * SUM(n)), 9) AS auc FROM ordered"""


def oracle_sql() -> dict[str, str]:
    whole = _flights(f"SELECT {', '.join(COLUMNS)} FROM flights")
    text = ", ".join(f"{_s(c)} AS {c}" for c in COLUMNS)
    return {
        "flights_view": whole,
        "scan_csv": whole,
        "table_shape": _flights(
            "SELECT COUNT(*) AS n_rows, CAST(18 AS BIGINT) AS n_columns FROM flights"
        ),
        "table_head": _flights(
            "SELECT * FROM flights ORDER BY flight_id, date, scheduled_departure, distance_miles LIMIT 5"
        ),
        "feed_rows": _flights(f"SELECT origin AS key, {text} FROM flights"),
        "feed_cap": _flights(
            f"SELECT origin AS key, flight_id FROM flights ORDER BY {', '.join(COLUMNS)} LIMIT 1000"
        ),
        "feed_key": _flights(
            "SELECT flight_id, CASE WHEN weather_origin <> 'Fog' THEN origin END AS key, "
            "'UNKNOWN' AS key_without_origin FROM flights"
        ),
        "time_features": _flights("""SELECT flight_id, d AS date,
  CAST(DAYOFWEEK(d) + 1 AS INTEGER) AS day_of_week, CAST(MONTH(d) AS INTEGER) AS month,
  CASE weather_origin WHEN 'Fog' THEN 615 WHEN 'Snow' THEN NULL
    ELSE CAST(SUBSTR(scheduled_departure, 1, 2) AS INTEGER) END AS scheduled_departure_hour,
  CASE WHEN weather_origin NOT IN ('Fog', 'Snow')
    THEN CAST(SUBSTR(scheduled_departure, 4, 2) AS INTEGER) END AS scheduled_departure_minute
FROM (SELECT flight_id, weather_origin, scheduled_departure,
        CASE WHEN carrier <> 'Brand#13' THEN CAST(date AS DATE) END AS d FROM flights) t"""),
        "cast_numeric": _flights(
            "SELECT flight_id, "
            + ", ".join(f"CASE WHEN carrier <> 'Brand#11' THEN {c} END AS {c}" for c in NUMERIC_COLUMNS)
            + " FROM flights"
        ),
        "delayed_flights": _flights(
            "SELECT flight_id, departure_delay_minutes, arrival_delay_minutes "
            "FROM flights WHERE is_delayed = 1"
        ),
        "status_label": _scored(
            "SELECT flight_id, CASE WHEN prediction = 1 AND weather_origin <> 'Fog' "
            "THEN 'DELAYED' ELSE 'ON TIME' END AS delay_status FROM scored"
        ),
        "valid_rows": _flights(
            f"SELECT flight_id, {_FEATURES} FROM flights WHERE weather_origin NOT IN ('Fog', 'Snow')"
        ),
        "hour_of_event": """SELECT event_id, CAST(HOUR(ts) AS INTEGER) AS hour,
  CAST(MINUTE(ts) AS INTEGER) AS minute,
  TRY_CAST(JSON_EXTRACT_STRING(props, '$.k') AS DOUBLE) AS k FROM events""",
        "delay_probability": _flights(
            f"SELECT flight_id, CAST({_RULE} AS BIGINT) AS prob_milli FROM flights"
        ),
        "delay_minutes": _lines(f"SELECT {_LINE_KEY}, CAST(dd AS BIGINT) AS delay_minutes FROM lines"),
        "delay_label": _flights(
            "SELECT flight_id, CASE WHEN departure_delay_minutes >= 15 THEN 1.0::DOUBLE "
            "ELSE 0.0::DOUBLE END AS label FROM flights"
        ),
        "arrival_delay": _lines(
            f"SELECT {_LINE_KEY}, CAST(GREATEST(0, dd + h6 % 26 - 10) AS BIGINT) AS arrival_delay FROM lines"
        ),
        "scheduled_arrival": _flights(
            f"SELECT flight_id, "
            f"{_clock(f'{_HOUR}*60 + {_MINUTE} + 60 + CAST(distance_miles AS BIGINT) % 361')} AS arrival "
            "FROM flights"
        ),
        "date_arith": _flights("""SELECT flight_id,
  CAST(CAST(date AS DATE) + CAST(CAST(distance_miles AS BIGINT) % 30 AS INTEGER) AS DATE) AS later,
  CAST(DATE_DIFF('day', DATE '1995-01-01', CAST(date AS DATE)) AS INTEGER) AS days_since,
  date AS date_text FROM flights"""),
        "round_weather": _flights("""SELECT flight_id,
  ROUND_EVEN(temperature_origin * 0.937::DOUBLE, 1) AS temperature,
  GREATEST(0.0::DOUBLE, ROUND_EVEN(wind_speed_origin * 1.237::DOUBLE - 5, 1)) AS wind,
  CAST(GREATEST(5, TRUNC(taxi_out_minutes / 1.7::DOUBLE)) AS INTEGER) AS taxi_out,
  CAST(GREATEST(3, TRUNC(taxi_in_minutes / 1.7::DOUBLE)) AS INTEGER) AS taxi_in FROM flights"""),
        "weather_mix": f"""WITH t AS (SELECT {_weather('(l_orderkey*7919 + l_partkey*104729) % 100')} AS weather
FROM lineitem) {_SHARE.format(c='weather', t='t')}""",
        "route_validity": f"""SELECT * FROM (SELECT {_LINE_KEY}, l_suppkey % 100 AS from_index,
  (l_suppkey % 100 + 1 + l_partkey % 99) % 100 AS to_index FROM lineitem) t
WHERE from_index <> to_index""",
        "dataset_summary": _flights("""SELECT COUNT(*) AS total,
  CAST(SUM(CASE WHEN is_delayed = 1 THEN 1 ELSE 0 END) AS BIGINT) AS delayed,
  CAST(SUM(CASE WHEN is_delayed = 0 THEN 1 ELSE 0 END) AS BIGINT) AS not_delayed,
  100.0::DOUBLE * CAST(SUM(is_delayed) AS DOUBLE) / COUNT(is_delayed) AS percent_delayed
FROM flights"""),
        "label_distribution": _flights(_SHARE.format(c="is_delayed", t="flights")),
        "distinct_counts": _flights(
            "SELECT COUNT(DISTINCT origin) AS n_origin, COUNT(DISTINCT carrier) AS n_carrier FROM flights"
        ),
        "overall_rate": _flights("SELECT AVG(is_delayed) AS delay_rate FROM flights"),
        "rate_by_carrier": _rate("carrier", "carrier"),
        "rate_by_hour": _rate(_HOUR, "dep_hour"),
        "rate_by_weather": _rate("weather_origin", "weather_origin"),
        "rate_by_priority": """SELECT o_orderpriority,
  AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS delay_rate
FROM orders GROUP BY o_orderpriority""",
        "origin_stats": _flights(
            "SELECT origin, COUNT(flight_id) AS total_flights, AVG(is_delayed) AS delay_rate "
            "FROM flights GROUP BY origin"
        ),
        "top_origins": _flights(
            "SELECT origin, COUNT(flight_id) AS total_flights, AVG(is_delayed) AS delay_rate "
            "FROM flights GROUP BY origin HAVING COUNT(flight_id) >= 600 "
            "ORDER BY delay_rate DESC, origin LIMIT 20"
        ),
        "correlation_matrix": _correlations(),
        "hist_departure": _histogram("departure_delay_minutes"),
        "hist_arrival": _histogram("arrival_delay_minutes"),
        "uplift_weather": _uplift(
            "weather_origin = 'Thunderstorm'", "weather_origin IN ('Clear', 'Cloudy')"
        ),
        "uplift_peak": _uplift(
            f"({_HOUR} BETWEEN 6 AND 9 OR {_HOUR} BETWEEN 16 AND 20)",
            f"NOT ({_HOUR} BETWEEN 6 AND 9 OR {_HOUR} BETWEEN 16 AND 20)",
        ),
        "uplift_hub": _uplift(_HUB, f"NOT ({_HUB})"),
        "metric_auc": _scored(_AUC),
        "metric_confusion": _scored(
            "SELECT is_delayed AS label, prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2"
        ),
        "metrics": _scored(_METRICS),
        "recall_delayed": _scored("""SELECT
  CAST(SUM(CASE WHEN prediction = 1 THEN is_delayed ELSE 0 END) AS BIGINT) AS caught,
  CAST(SUM(is_delayed) AS BIGINT) AS delayed,
  SUM(CASE WHEN prediction = 1 THEN is_delayed ELSE 0 END) / SUM(is_delayed) AS recall FROM scored"""),
        "split_counts": _flights(
            f"SELECT CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS side, "
            "COUNT(*) AS n, AVG(is_delayed) AS delay_rate FROM flights GROUP BY 1"
        ),
        "split_random": _flights(_SPLIT),
        "split_default": _flights(_SPLIT),
        "category_index": _by_category(f"SELECT *, {_POSITION} AS index FROM freq", "flights"),
        "indexer_index": _by_category(f"SELECT *, {_POSITION} AS index FROM freq", "flights"),
        "category_encoded": _flights(f"""+ seen AS (SELECT * FROM flights WHERE {_BUCKET} < 80),
o AS (SELECT origin, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, origin) - 1 AS i
      FROM seen GROUP BY origin),
c AS (SELECT carrier, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, carrier) - 1 AS i
      FROM seen GROUP BY carrier)
SELECT flight_id,
  CASE WHEN weather_origin <> 'Snow' AND o.i IS NOT NULL THEN o.i
    ELSE (SELECT COUNT(*) FROM o) END AS origin_index,
  COALESCE(c.i, (SELECT COUNT(*) FROM c)) AS carrier_index
FROM flights LEFT JOIN o USING (origin) LEFT JOIN c USING (carrier) WHERE {_BUCKET} >= 80"""),
        "onehot_width": _by_category(
            f"SELECT category, value, COUNT(*) OVER (PARTITION BY category) AS width, "
            f"{_POSITION} AS slot FROM freq",
            "flights",
        ),
        "assembled": _flights(
            f"+ seen AS (SELECT * FROM flights WHERE {_BUCKET} < 80),\nwidth AS (SELECT "
            + " + ".join(f"COUNT(DISTINCT {c})" for c in CATEGORICAL_FEATURES)
            + f" + {len(NUMERIC_FEATURES)} AS width FROM seen)\nSELECT flight_id, width, "
            + ", ".join(
                f"CAST({_NUMERIC_FEATURES.get(c, c).rsplit(' AS ', 1)[0]} AS DOUBLE) AS {c}"
                for c in NUMERIC_FEATURES
            )
            + " FROM flights, width"
        ),
        "model_roundtrip": _flights(
            f"SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS n_changed FROM flights WHERE {_BUCKET} >= 80"
        ),
        "gbt_train": _flights(
            "SELECT COUNT(*) AS n, TRUE AS trees_in_range, TRUE AS auc_in_range, TRUE AS accuracy_near_majority, "
            f"TRUE AS recall_is_accuracy FROM flights WHERE {_BUCKET} >= 80"
        ),
        "gbt_predict": _flights(
            f"SELECT {_PASSED}, TRUE AS status_agrees FROM flights WHERE {_BUCKET} >= 80"
        ),
        "stream_score": _flights(
            f"SELECT {_PASSED}, TRUE AS status_agrees, TRUE AS equals_batch FROM flights"
        ),
        "stream_parse": whole,
        "stream_features": _flights(f"SELECT flight_id, {_FEATURES} FROM flights"),
        "stream_resume": _flights("SELECT flight_id, origin, is_delayed FROM flights"),
        "stream_recover": _flights("SELECT flight_id, origin, is_delayed FROM flights"),
        "stream_latest": _flights(
            f"SELECT flight_id, origin, is_delayed FROM flights WHERE {_BUCKET} >= 80"
        ),
        "stream_rejects": _flights("""SELECT CASE WHEN carrier IN
    ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14') THEN 'reject' ELSE 'flight' END AS kind,
  CASE carrier WHEN 'Brand#11' THEN SUBSTR(j, 1, 40)
    WHEN 'Brand#12' THEN 'no json: ' || SUBSTR(j, 15, 20)
    WHEN 'Brand#13' THEN '[' || SUBSTR(j, 14, 12) || ']'
    WHEN 'Brand#14' THEN NULL ELSE carrier END AS what,
  COUNT(*) AS n
FROM (SELECT carrier, '{"flight_id":"' || flight_id || '","date":"' || date || '",' AS j FROM flights) t
GROUP BY 1, 2"""),
        "stream_monitor": _flights("""SELECT COUNT(*) AS rows_reported, COUNT(*) AS rows_written,
  CAST(SUM(CASE WHEN carrier IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14') THEN 1 ELSE 0 END)
    AS BIGINT) AS unreadable,
  CAST(SUM(CASE WHEN carrier IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14') THEN 1 ELSE 0 END)
    AS BIGINT) AS skipped FROM flights"""),
        "distinct_by_month": _flights("""+ long AS (
  SELECT SUBSTR(date, 1, 7) AS month, 'origin' AS category, origin AS v FROM flights
  UNION ALL SELECT SUBSTR(date, 1, 7), 'destination', destination FROM flights
  UNION ALL SELECT SUBSTR(date, 1, 7), 'carrier', carrier FROM flights)
SELECT month, category, COUNT(DISTINCT v) AS n FROM long GROUP BY 1, 2
UNION ALL SELECT 'all', category, COUNT(DISTINCT v) FROM long GROUP BY 2"""),
        "training_summary": _flights("""+ l AS (
  SELECT CASE WHEN weather_origin <> 'Snow' THEN is_delayed END AS y, weather_destination AS w
  FROM flights)
SELECT COUNT(*) AS total, CAST(SUM(y) AS BIGINT) AS delayed, CAST(SUM(1 - y) AS BIGINT) AS not_delayed,
  SUM(y) * 100 / COUNT(y) AS percent_delayed, COUNT(*) - COUNT(y) AS unlabelled,
  COUNT(*) FILTER (w = 'Fog') AS skipped, COUNT(*) AS both_sides FROM l"""),
    }
