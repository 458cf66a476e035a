"""DuckDB SQL equivalent to each registered query, over the same Parquet
tables (views ``events``, ``nation`` ...). Doubles are rounded to 6 decimals
on both sides; calendar fields are cast to INTEGER and sums to BIGINT."""

from __future__ import annotations

from cabmeter.schemas import (
    DEFAULT_BASE_FEE, DEFAULT_BASE_RATE, SCENARIOS, SERVICES, SPLIT_SEED,
    SAMPLE_SALT, TRAIN_PERCENT,
)


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _service_case() -> str:
    def pick(i: int) -> str:
        return f"CASE WHEN ev.cab_type = 'Uber' THEN '{SERVICES['Uber'][i]}' ELSE '{SERVICES['Lyft'][i]}' END"

    events = ["click", "view", "purchase", "signup"]
    whens = " ".join(f"WHEN ev.event_type = '{e}' THEN {pick(i)}" for i, e in enumerate(events))
    return f"CASE {whens} ELSE {pick(4)} END"


def _hash32(col: str, salt: str = "") -> str:
    return f"CAST(('0x' || substr(md5('{salt}{SPLIT_SEED}:' || CAST({col} AS VARCHAR)), 1, 8)) AS BIGINT)"


# rides -> clean -> feat: the shared derivation of the test-data rides.
BASE_CTES = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CASE WHEN user_id % 2 = 0 THEN 'Uber' ELSE 'Lyft' END AS cab_type,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / {_d(10.0)} AS distance,
         {_d(1.0)} + CAST(user_id % 5 AS DOUBLE) * {_d(0.25)} AS surge_multiplier
  FROM events),
rides AS (
  SELECT ev.event_id AS ride_id,
         epoch_us(ev.ts) // 1000 AS time_stamp,
         ev.cab_type,
         {_service_case()} AS name,
         s.n_name AS source,
         d.n_name AS destination,
         ev.distance,
         ev.surge_multiplier,
         CASE WHEN ev.event_id % 97 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN ev.event_id % 101 = 0 THEN {_d(0.0)}
              ELSE {_d(5.0)} + {_d(2.5)} * ev.distance * ev.surge_multiplier + ev.value * {_d(0.01)}
         END AS price
  FROM ev
  LEFT JOIN nation s ON s.n_nationkey = ev.user_id % 25
  LEFT JOIN nation d ON d.n_nationkey = ev.event_id % 25),
clean AS (
  SELECT * FROM rides WHERE price IS NOT NULL AND price > 0 AND distance > 0),
cal AS (
  SELECT *,
         CAST(hour(make_timestamp(time_stamp * 1000)) AS INTEGER) AS hour,
         CAST(dayofweek(make_timestamp(time_stamp * 1000)) + 1 AS INTEGER) AS day_of_week,
         CAST(month(make_timestamp(time_stamp * 1000)) AS INTEGER) AS month
  FROM clean),
feat AS (
  SELECT *,
         CASE WHEN hour BETWEEN 6 AND 11 THEN 'morning'
              WHEN hour BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN hour BETWEEN 17 AND 20 THEN 'evening'
              ELSE 'night' END AS time_of_day,
         CAST(CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         CAST(CASE WHEN surge_multiplier > {_d(1.0)} THEN 1 ELSE 0 END AS INTEGER) AS is_surge,
         CASE WHEN distance < 1 THEN 'short'
              WHEN distance < 3 THEN 'medium'
              ELSE 'long' END AS distance_category
  FROM cal)"""


def _with(*extra: str) -> str:
    ctes = [BASE_CTES.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


DAY_CASE = ("CASE day_of_week WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue' "
            "WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' WHEN 7 THEN 'Sat' END")

SURGE_EXPR = f"""greatest({_d(1.0)}, least({_d(3.0)}, round_even(
  CASE WHEN day_of_week IN (1, 6, 7) AND (hour >= 22 OR hour <= 3) THEN least(base * {_d(1.4)}, {_d(3.0)})
       WHEN day_of_week IN (1, 6, 7) AND hour BETWEEN 10 AND 14 THEN least(base * {_d(1.2)}, {_d(2.5)})
       ELSE base END * {_d(4.0)}, 0) / {_d(4.0)}))"""

SURGE_BASE = f"""CASE WHEN hour BETWEEN 7 AND 9 THEN {_d(1.75)}
       WHEN hour BETWEEN 17 AND 19 THEN {_d(2.0)}
       WHEN hour BETWEEN 0 AND 4 THEN {_d(1.5)}
       WHEN hour BETWEEN 10 AND 16 THEN {_d(1.0)}
       ELSE {_d(1.25)} END"""

HOURLY_CTE = "hourly AS (SELECT hour, avg(price) AS avg_price, count(*) AS ride_count FROM feat GROUP BY hour)"
DMAP_CTE = """dmap AS (
  SELECT lower(trim(source)) AS source, lower(trim(destination)) AS destination, max(distance) AS max_distance
  FROM clean WHERE source IS NOT NULL AND destination IS NOT NULL GROUP BY 1, 2)"""


MAPPED_CTE = """dmap AS (
  SELECT lower(trim(source)) AS source, lower(trim(destination)) AS destination, max(distance) AS max_distance
  FROM clean WHERE source IS NOT NULL AND destination IS NOT NULL AND ride_id % 25 <> 7 GROUP BY 1, 2)"""


def _allowed_service_sql() -> str:
    terms = []
    for provider, services in SERVICES.items():
        names = ", ".join(f"'{s}'" for s in services)
        terms.append(f"(cab_type = '{provider}' AND name IN ({names}))")
    return "coalesce(" + " OR ".join(terms) + ", false)"


def _scenario_list() -> str:
    items = ", ".join(f"{{'scenario': '{name}', 'multiplier': {_d(mult)}}}" for name, mult in SCENARIOS)
    return f"[{items}]"


# Quote requests with the faults of cabmeter.plans.queries, and their verdicts.
CHECKED_CTES = (MAPPED_CTE, """places AS (
  SELECT DISTINCT lower(trim(n_name)) AS place FROM nation)""", """quote_req AS (
  SELECT ride_id, cab_type, CASE WHEN ride_id % 31 = 2 THEN 'Rocket' ELSE name END AS name,
         CASE ride_id % 31 WHEN 0 THEN 'Atlantis' WHEN 7 THEN '  ' || upper(source) || ' ' ELSE source END AS source,
         CASE WHEN ride_id % 31 = 1 THEN 'Nowhere' ELSE destination END AS destination,
         CASE WHEN ride_id % 31 = 6 THEN 3.5 ELSE surge_multiplier END AS surge_multiplier,
         CAST(CASE WHEN ride_id % 31 = 3 THEN 24 ELSE hour(make_timestamp(time_stamp * 1000)) END AS INTEGER) AS hour,
         CAST(CASE WHEN ride_id % 31 = 4 THEN 8 ELSE dayofweek(make_timestamp(time_stamp * 1000)) + 1 END AS INTEGER)
           AS day_of_week,
         CAST(CASE WHEN ride_id % 31 = 5 THEN 0 ELSE month(make_timestamp(time_stamp * 1000)) END AS INTEGER) AS month
  FROM rides)""", """flagged AS (
  SELECT q.*, ps.place AS src_ok, pd.place AS dst_ok, m.max_distance AS distance
  FROM quote_req q
  LEFT JOIN places ps ON ps.place = lower(trim(q.source))
  LEFT JOIN places pd ON pd.place = lower(trim(q.destination))
  LEFT JOIN dmap m ON m.source = lower(trim(q.source)) AND m.destination = lower(trim(q.destination)))""", f"""checked AS (
  SELECT *,
  CASE WHEN lower(trim(source)) = lower(trim(destination)) THEN 'same_endpoints'
       WHEN NOT {_allowed_service_sql()} THEN 'unknown_service'
       WHEN src_ok IS NULL THEN 'unknown_source'
       WHEN dst_ok IS NULL THEN 'unknown_destination'
       WHEN NOT coalesce(hour BETWEEN 0 AND 23, false) THEN 'bad_hour'
       WHEN NOT coalesce(day_of_week BETWEEN 1 AND 7, false) THEN 'bad_day'
       WHEN NOT coalesce(month BETWEEN 1 AND 12, false) THEN 'bad_month'
       WHEN NOT coalesce(surge_multiplier BETWEEN 1.0 AND 3.0, false) THEN 'bad_surge'
       WHEN distance IS NULL THEN 'unknown_route'
  END AS reject_reason
  FROM flagged)""")


SQL: dict[str, str] = {
    "hourly_stats": _with() + f"""
SELECT hour, {r('avg(price)', 'avg_price')}, count(*) AS ride_count
FROM feat GROUP BY hour ORDER BY hour""",

    "clean_rides": _with() + """
SELECT ride_id, time_stamp, cab_type, name, source, destination,
       round(distance, 6) AS distance, round(surge_multiplier, 6) AS surge_multiplier,
       round(price, 6) AS price
FROM clean""",

    "ride_features": _with() + """
SELECT ride_id, time_stamp, cab_type, name, source, destination,
       round(distance, 6) AS distance, round(surge_multiplier, 6) AS surge_multiplier,
       round(price, 6) AS price, hour, day_of_week, month, time_of_day, is_weekend,
       is_surge, distance_category
FROM feat""",

    "suggested_surge": _with(f"""slots AS (
  SELECT hour, day_of_week, count(*) AS ride_count, avg(surge_multiplier) AS avg_observed_surge
  FROM feat GROUP BY hour, day_of_week)""", f"""based AS (SELECT *, {SURGE_BASE} AS base FROM slots)""") + f"""
SELECT hour, day_of_week, ride_count, {r('avg_observed_surge', 'avg_observed_surge')},
       {r(SURGE_EXPR, 'suggested_surge')}
FROM based""",

    "load_profile": _with() + """
SELECT count(*) AS row_count, CAST(9 AS INTEGER) AS column_count FROM rides""",

    "daily_stats": _with() + f"""
SELECT day_of_week, {r('avg(price)', 'avg_price')}, {DAY_CASE} AS day_name
FROM feat GROUP BY day_of_week ORDER BY day_of_week""",

    "service_stats": _with() + f"""
SELECT cab_type, name, {r('avg(price)', 'avg_price')} FROM feat GROUP BY cab_type, name""",

    "top_services": _with("svc AS (SELECT cab_type, name, avg(price) AS avg_price FROM feat GROUP BY cab_type, name)") + f"""
SELECT cab_type, name, {r('avg_price', 'avg_price')} FROM svc
ORDER BY avg_price DESC, cab_type, name LIMIT 7""",

    "surge_stats": _with() + f"""
SELECT round(surge_multiplier, 6) AS surge_multiplier, {r('avg(price)', 'avg_price')}, count(*) AS "count"
FROM feat GROUP BY surge_multiplier ORDER BY surge_multiplier""",

    "dashboard_kpis": _with(HOURLY_CTE, """peak AS (
  SELECT min(hour) AS peak_hour FROM hourly
  WHERE hour IS NOT NULL
    AND avg_price = (SELECT max(avg_price) FROM hourly WHERE hour IS NOT NULL))""") + f"""
SELECT CAST(sum(ride_count) AS BIGINT) AS total_rides,
       {r('avg(avg_price)', 'avg_price')},
       {r('max(avg_price)', 'peak_hour_price')},
       (SELECT peak_hour FROM peak) AS peak_hour,
       format('{{:,}}', CAST(sum(ride_count) AS BIGINT)) AS total_rides_text,
       printf('$%.2f', avg(avg_price)) AS avg_price_text,
       printf('$%.2f', max(avg_price)) AS peak_hour_price_text,
       CAST((SELECT peak_hour FROM peak) AS VARCHAR) || ':00' AS peak_hour_text
FROM hourly""",

    "dashboard_grouping_sets": _with() + f"""
SELECT CASE grouping(hour, day_of_week, cab_type, name, surge_multiplier)
         WHEN 15 THEN 'hourly' WHEN 23 THEN 'daily' WHEN 25 THEN 'service' WHEN 30 THEN 'surge' END
         AS grouping_set,
       hour, day_of_week, cab_type, name, round(surge_multiplier, 6) AS surge_multiplier,
       {r('avg(price)', 'avg_price')}, count(*) AS ride_count
FROM feat
GROUP BY GROUPING SETS ((hour), (day_of_week), (cab_type, name), (surge_multiplier))""",

    "dashboard_one_pass": _with() + f"""
SELECT CASE grouping(hour, day_of_week, cab_type, name, surge_multiplier) WHEN 15 THEN 'hourly' WHEN 23 THEN 'daily'
         WHEN 25 THEN 'service' WHEN 30 THEN 'surge' ELSE 'whole' END AS part,
       hour, day_of_week, cab_type, name, round(surge_multiplier, 6) AS surge_multiplier,
       CAST(NULL AS VARCHAR) AS ride, CAST(NULL AS DOUBLE) AS distance, {r('avg(price)', 'avg_price')}, count(*) AS ride_count,
       CASE WHEN grouping(hour, day_of_week, cab_type, name, surge_multiplier) = 31 THEN round(regr_slope(price, distance), 6) END AS slope,
       CASE WHEN grouping(hour, day_of_week, cab_type, name, surge_multiplier) = 31 THEN round(regr_intercept(price, distance), 6) END AS intercept,
       CASE WHEN grouping(hour, day_of_week, cab_type, name, surge_multiplier) = 31 THEN round(regr_r2(price, distance), 6) END AS r2
FROM feat
GROUP BY GROUPING SETS ((hour), (day_of_week), (cab_type, name), (surge_multiplier), ())
UNION ALL
SELECT 'points', NULL, NULL, NULL, NULL, NULL, CAST(ride_id AS VARCHAR), round(distance, 6), round(price, 6), 1, NULL, NULL, NULL
FROM feat WHERE {_hash32('ride_id', SAMPLE_SALT)} % 100 < 10""",

    "distance_price_sample": _with(f"""hashed AS (SELECT ride_id, distance, price, {_hash32('ride_id', SAMPLE_SALT)} AS h FROM clean)""") + """
SELECT round(distance, 6) AS distance, round(price, 6) AS price FROM hashed WHERE h % 100 < 10""",

    "distance_price_points": _with(f"""hashed AS (SELECT ride_id, distance, price, {_hash32('ride_id', SAMPLE_SALT)} AS h FROM clean)""") + """
SELECT round(distance, 6) AS distance, round(price, 6) AS price FROM (
  SELECT * FROM hashed WHERE h % 100 < 10 ORDER BY h, CAST(ride_id AS VARCHAR) LIMIT 50)""",

    "ride_calendar": _with("""shifted AS (
  SELECT ride_id, time_stamp + (ride_id % 12) * 30 * 86400000 AS time_stamp FROM clean)""") + """
SELECT ride_id, time_stamp,
       CAST(hour(make_timestamp(time_stamp * 1000)) AS INTEGER) AS hour,
       CAST(dayofweek(make_timestamp(time_stamp * 1000)) + 1 AS INTEGER) AS day_of_week,
       CAST(month(make_timestamp(time_stamp * 1000)) AS INTEGER) AS month
FROM shifted""",

    "fare_trend": _with() + f"""
SELECT CAST(regr_count(price, distance) AS BIGINT) AS n,
       {r('regr_slope(price, distance)', 'slope')},
       {r('regr_intercept(price, distance)', 'intercept')},
       {r('regr_r2(price, distance)', 'r2')},
       {r('corr(distance, price)', 'correlation')}
FROM clean""",

    "distance_map": _with(DMAP_CTE) + """
SELECT source, destination, round(max_distance, 6) AS max_distance FROM dmap""",

    "route_distance": _with(MAPPED_CTE) + """
SELECT r.ride_id, r.source, r.destination, round(m.max_distance, 6) AS route_distance
FROM rides r LEFT JOIN dmap m
  ON m.source = lower(trim(r.source)) AND m.destination = lower(trim(r.destination))""",

    "quote_requests_checked": _with(*CHECKED_CTES) + """
SELECT ride_id, round(distance, 6) AS distance, reject_reason FROM checked""",

    "quote_requests_filled": _with(f"""req AS (
  SELECT ride_id, CAST(hour(make_timestamp(time_stamp * 1000)) AS INTEGER) AS hour,
         CAST(dayofweek(make_timestamp(time_stamp * 1000)) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN ride_id % 3 <> 0 THEN surge_multiplier END AS given
  FROM rides)""", f"""based AS (SELECT *, {SURGE_BASE} AS base FROM req)""") + f"""
SELECT ride_id, hour, day_of_week, round(coalesce(given, {SURGE_EXPR}), 6) AS surge_multiplier FROM based""",

    "scenario_prices": _with(f"""tariffs AS (
  SELECT ride_id AS tariff_id, distance, {_d(DEFAULT_BASE_RATE)} AS base_rate, {_d(DEFAULT_BASE_FEE)} AS base_fee
  FROM clean)""", """based AS (SELECT *, base_fee + distance * base_rate AS base_price FROM tariffs)""",
        f"""expanded AS (
  SELECT b.*, unnest({_scenario_list()}, recursive := true) FROM based b)""",
        """priced AS (
  SELECT *, base_price * multiplier AS estimated_price FROM expanded)""",
        """saved AS (
  SELECT *, max(estimated_price) OVER (PARTITION BY tariff_id) - estimated_price AS savings FROM priced)""") + """
SELECT tariff_id, round(distance, 6) AS distance, round(base_rate, 6) AS base_rate,
       round(base_fee, 6) AS base_fee, round(base_price, 6) AS base_price, scenario,
       round(multiplier, 6) AS multiplier, round(estimated_price, 6) AS estimated_price,
       round(savings, 6) AS savings,
       CAST(multiplier AS VARCHAR) || 'x' AS multiplier_text,
       printf('$%.2f', estimated_price) AS estimated_price_text,
       CASE WHEN savings > 0 THEN printf('$%.2f', savings) ELSE '-' END AS savings_text,
       CAST(row_number() OVER (PARTITION BY tariff_id ORDER BY estimated_price, scenario) AS INTEGER)
         AS price_rank
FROM saved""",

    "train_test_split": _with() + f"""
SELECT ride_id, CASE WHEN {_hash32('ride_id')} % 100 < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split
FROM clean""",
}


# -- ML fit side --------------------------------------------------------------------

SPLIT_CTES = (
    f"train AS (SELECT * FROM feat WHERE {_hash32('ride_id')} % 100 < {TRAIN_PERCENT})",
    f"test AS (SELECT * FROM feat WHERE {_hash32('ride_id')} % 100 >= {TRAIN_PERCENT})",
)

_CATS = ["cab_type", "name", "source", "destination", "time_of_day", "distance_category"]
_NUMS = ["distance", "surge_multiplier", "hour", "day_of_week", "month", "is_weekend", "is_surge"]


def _long(src: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS label FROM {src}" for c in _CATS)


LABEL_CTES = (
    f"train_long AS ({_long('train')})",
    """counts AS (
  SELECT feature, label, count(*) AS label_count FROM train_long WHERE label IS NOT NULL GROUP BY 1, 2)""",
    """idx AS (
  SELECT feature, label, label_count,
         row_number() OVER (PARTITION BY feature ORDER BY label_count DESC, label) - 1 AS label_index,
         count(*) OVER (PARTITION BY feature) AS block_size
  FROM counts)""",
)

_not_null_numeric = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in _NUMS)


def _std_select(c: str) -> str:
    return (f"SELECT '{c}' AS feature, CAST(NULL AS VARCHAR) AS label, round(s.sd, 6) AS raw_std, "
            f"round(CASE WHEN s.sd > 0 THEN (SELECT stddev_samp(CAST({c} AS DOUBLE) / s.sd) FROM train) "
            f"ELSE {_d(0.0)} END, 6) AS scaled_std "
            f"FROM (SELECT stddev_samp(CAST({c} AS DOUBLE)) AS sd FROM train) s")


# A one-hot slot is a 0/1 indicator: with c ones among n rows its sample
# deviation is sqrt(c (n - c) / (n (n - 1))).
_SLOT_STD = """SELECT feature, label,
       round(sqrt(CAST(label_count AS DOUBLE) * (n - label_count) / (n * (n - 1.0))), 6) AS raw_std,
       CASE WHEN label_count < n THEN 1.0 ELSE 0.0 END AS scaled_std
FROM (SELECT feature, label, label_count, (SELECT count(*) FROM train) AS n FROM idx)"""


SQL.update({
    "label_index": _with(*SPLIT_CTES, *LABEL_CTES) + """
SELECT feature, label, label_count, CAST(label_index AS INTEGER) AS label_index FROM idx""",

    "onehot_slot_counts": _with(*SPLIT_CTES, *LABEL_CTES, f"test_long AS ({_long('feat')})") + """
SELECT t.feature, CAST(i.label_index AS INTEGER) AS slot, CAST(i.block_size AS INTEGER) AS block_size,
       count(*) AS row_count
FROM test_long t JOIN idx i ON i.feature = t.feature AND i.label = t.label
GROUP BY 1, 2, 3""",

    "assembled_rows": _with(f"""labelled AS (
  SELECT * REPLACE (CASE WHEN ride_id % 53 = 0 THEN NULL WHEN ride_id % 59 = 0 THEN CAST('NaN' AS DOUBLE)
                    ELSE surge_multiplier END AS surge_multiplier),
         CASE WHEN {_hash32('ride_id')} % 100 < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS split
  FROM feat)""") + f"""
SELECT split, count(*) AS total_rows,
       count(*) FILTER (WHERE {_not_null_numeric}) AS kept_rows,
       count(*) - count(*) FILTER (WHERE {_not_null_numeric}) AS skipped_rows
FROM labelled GROUP BY split""",

    "scaled_feature_std": _with(*SPLIT_CTES, *LABEL_CTES) + "\n"
        + "\nUNION ALL\n".join([_SLOT_STD] + [_std_select(c) for c in _NUMS]),

    "fare_enet_distance": _with(*SPLIT_CTES, """st AS (
  SELECT count(*) AS n, avg(distance) AS mx, avg(price) AS my, stddev_pop(distance) AS sx,
         stddev_pop(price) AS sy, corr(distance, price) AS r
  FROM train WHERE distance IS NOT NULL AND NOT isnan(distance))""", f"""be AS (
  SELECT *, sign(r) * greatest(abs(r) - ({_d(0.1)} / sy) * {_d(0.5)}, {_d(0.0)})
            / ({_d(1.0)} + ({_d(0.1)} / sy) * {_d(0.5)}) AS beta
  FROM st)""") + """
SELECT n, round(my - (beta * sy / sx) * mx, 6) AS intercept, round(beta * sy / sx, 6) AS slope FROM be""",

    "regression_metrics": _with(f"""pred AS (
  SELECT price, {_d(5.0)} + {_d(2.5)} * distance * surge_multiplier AS prediction FROM clean)""") + """
SELECT count(*) AS n,
       round(sqrt(avg((prediction - price) * (prediction - price))), 6) AS rmse,
       round(avg(abs(prediction - price)), 6) AS mae,
       round(1 - sum((prediction - price) * (prediction - price)) / (var_pop(price) * count(*)), 6) AS r2
FROM pred""",
})


# -- messages and streams -------------------------------------------------------------

REQ_CTE = """req AS (
  SELECT ride_id, cab_type, name, source, destination, distance, surge_multiplier,
         CAST(hour(make_timestamp(time_stamp * 1000)) AS INTEGER) AS hour,
         CAST(dayofweek(make_timestamp(time_stamp * 1000)) + 1 AS INTEGER) AS day_of_week,
         CAST(month(make_timestamp(time_stamp * 1000)) AS INTEGER) AS month
  FROM rides)"""

_REQ_COLS = """cab_type, name, source, destination, round(distance, 6) AS distance,
       round(surge_multiplier, 6) AS surge_multiplier, hour, day_of_week, month"""

_bad_request = " OR ".join(
    [f"{c} IS NULL" for c in ["distance", "surge_multiplier", "hour", "day_of_week", "month"]]
    + ["isnan(distance)", "isnan(surge_multiplier)"]
)

SQL.update({
    "request_messages": _with(REQ_CTE) + f"""
SELECT ride_id, {_REQ_COLS} FROM req""",

    "stream_ride_features": _with(REQ_CTE) + f"""
SELECT ride_id, {_REQ_COLS},
       CASE WHEN hour BETWEEN 6 AND 11 THEN 'morning'
            WHEN hour BETWEEN 12 AND 16 THEN 'afternoon'
            WHEN hour BETWEEN 17 AND 20 THEN 'evening'
            ELSE 'night' END AS time_of_day,
       CAST(CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(CASE WHEN surge_multiplier > {_d(1.0)} THEN 1 ELSE 0 END AS INTEGER) AS is_surge,
       CASE WHEN distance < 1 THEN 'short' WHEN distance < 3 THEN 'medium' ELSE 'long' END
         AS distance_category
FROM req WHERE NOT ({_bad_request}) AND ride_id % 23 > 8""",

    "stream_rejects": _with(REQ_CTE) + f"""
SELECT ride_id,
       CASE ride_id % 23 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'null_value' WHEN 2 THEN 'empty_record'
            WHEN 3 THEN 'invalid_distance' WHEN 4 THEN 'invalid_hour' WHEN 5 THEN 'invalid_surge_multiplier'
            WHEN 6 THEN 'invalid_distance' WHEN 7 THEN 'invalid_month' WHEN 8 THEN 'invalid_day_of_week'
            ELSE CASE WHEN distance IS NULL OR isnan(distance) THEN 'invalid_distance'
            WHEN surge_multiplier IS NULL OR isnan(surge_multiplier) THEN 'invalid_surge_multiplier'
            WHEN hour IS NULL THEN 'invalid_hour'
            WHEN day_of_week IS NULL THEN 'invalid_day_of_week'
            ELSE 'invalid_month' END END AS reject_reason
FROM req WHERE ({_bad_request}) OR ride_id % 23 <= 8""",
})


# -- file sources ------------------------------------------------------------------------

SQL.update({
    "rides_csv_scan": _with() + """
SELECT ride_id, time_stamp, cab_type, name, source, destination,
       round(distance, 6) AS distance, round(surge_multiplier, 6) AS surge_multiplier,
       round(price, 6) AS price
FROM rides""",

    "distance_map_csv_scan": _with(DMAP_CTE) + """
SELECT source, destination, round(max_distance, 6) AS max_distance FROM dmap""",

    "request_csv_scan": _with(REQ_CTE) + f"""
SELECT {_REQ_COLS} FROM req""",
})


# -- the one-feature model in closed form ----------------------------------------------

# Elastic net of one standardised feature: the correlation shrunk by the L1
# part, over one plus the L2 part; MLlib scales both by the label's deviation.
LINE_CTES = (*SPLIT_CTES, """st AS (
  SELECT avg(distance) AS mx, avg(price) AS my, stddev_pop(distance) AS sx,
         stddev_pop(price) AS sy, corr(distance, price) AS r
  FROM train WHERE distance IS NOT NULL AND NOT isnan(distance))""", f"""line AS (
  SELECT my - slope * mx AS intercept, slope FROM (
    SELECT *, sign(r) * greatest(abs(r) - ({_d(0.1)} / sy) * {_d(0.5)}, {_d(0.0)})
              / ({_d(1.0)} + ({_d(0.1)} / sy) * {_d(0.5)}) * sy / sx AS slope FROM st))""")
_LINE = "((SELECT intercept FROM line) + (SELECT slope FROM line) * distance)"

SQL.update({
    "train_and_evaluate_distance": _with(*LINE_CTES) + f"""
SELECT ride_id, round(price, 6) AS price, {r(_LINE, 'prediction')} FROM test""",

    "model_metrics_distance": _with(*LINE_CTES, f"pred AS (SELECT price, {_LINE} AS prediction FROM test)") + """
SELECT count(*) AS n,
       round(sqrt(avg((prediction - price) * (prediction - price))), 6) AS rmse,
       round(avg(abs(prediction - price)), 6) AS mae,
       round(1 - sum((prediction - price) * (prediction - price)) / (var_pop(price) * count(*)), 6) AS r2
FROM pred""",

    "prediction_preview_distance": _with(*LINE_CTES) + f"""
SELECT ride_id, round(price, 6) AS price, {r(_LINE, 'prediction')} FROM test ORDER BY ride_id LIMIT 10""",

    "quote_prices_distance": _with(*LINE_CTES, *CHECKED_CTES) + f"""
SELECT ride_id, round(distance, 6) AS distance, round(surge_multiplier, 6) AS surge_multiplier,
       {r(_LINE, 'predicted_price')}, {r(_LINE + ' / surge_multiplier', 'base_price')},
       {r(_LINE + ' / distance', 'price_per_mile')}
FROM checked WHERE reject_reason IS NULL""",

    "model_round_trip_distance": _with(*LINE_CTES) + f"""
SELECT ride_id, {r(_LINE, 'prediction')} FROM feat""",

    "stream_scores_distance": _with(*LINE_CTES, REQ_CTE) + f"""
SELECT cab_type, name, round(distance, 6) AS distance, round(surge_multiplier, 6) AS surge_multiplier,
       {r(_LINE, 'predicted_price')}, ride_id
FROM req WHERE NOT ({_bad_request}) AND ride_id % 23 > 8""",

    "model_invariants": _with(*SPLIT_CTES) + """
SELECT * FROM (VALUES ('saved_equals_loaded', true, CAST(0 AS BIGINT)), ('batch_equals_stream', true, CAST(0 AS BIGINT)),
  ('model_equals_sum_of_terms', true, CAST(0 AS BIGINT)), ('fit_is_optimal', true, CAST(0 AS BIGINT)))
  AS t(invariant, holds, lost)
UNION ALL SELECT 'rows_without_a_number_are_skipped', true, count(*) FROM feat WHERE ride_id % 11 = 0""",

    # What the loosely typed records stand for, by the ride's id.
    "requests_from_records": _with(REQ_CTE) + """
SELECT ride_id, cab_type, name, source, destination,
  CASE WHEN ride_id % 19 NOT IN (4, 5) THEN round(distance, 6) END AS distance,
  round(surge_multiplier, 6) AS surge_multiplier,
  CASE WHEN ride_id % 23 NOT IN (6, 7) THEN hour END AS hour, day_of_week,
  CASE WHEN ride_id % 17 <> 3 THEN month END AS month,
  nullif(concat_ws(',', CASE WHEN ride_id % 19 IN (4, 5) THEN 'distance' END,
    CASE WHEN ride_id % 23 IN (6, 7) THEN 'hour' END, CASE WHEN ride_id % 17 = 3 THEN 'month' END), '') AS bad_fields
FROM req""",
})
