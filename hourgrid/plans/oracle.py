"""The same queries as plain SQL for an independent engine: the definitions, without regard to speed.

Shared text is kept in named common table expressions; a query lists only its own last step.
"""

from __future__ import annotations

HOURLY_RAW = """
raw AS (
  SELECT date_trunc('hour', e.ts) AS transit_timestamp,
    CASE WHEN e.user_id % 20 = 3 AND e.event_id % 50 = 0 THEN 'tram' WHEN e.user_id % 20 < 16 THEN 'subway'
         WHEN e.user_id % 20 < 19 THEN 'staten_island_railway' ELSE 'tram' END AS transit_mode,
    CAST(e.user_id % 20 AS VARCHAR) AS station_complex_id,
    'S' || CAST((e.user_id % 20) % 18 AS VARCHAR) AS station_complex,
    r.r_name AS borough,
    CASE WHEN e.event_id % 2 = 0 THEN 'card' ELSE 'tap' END AS payment_method,
    e.event_type AS fare_class_category,
    CAST(round(e.value) AS BIGINT) - CASE WHEN e.event_type = 'error' THEN 40 ELSE 0 END AS ridership,
    CAST(regexp_extract(e.props, '"k": *(-?[0-9]+)', 1) AS BIGINT) % 3 AS transfers,
    40.5 + (e.user_id % 20) * 0.02::DOUBLE + (e.event_id % 2) * 0.001::DOUBLE AS latitude,
    -74.0::DOUBLE + (e.user_id % 20) * 0.01::DOUBLE AS longitude
  FROM events e JOIN region r ON r.r_regionkey = (e.user_id % 20) % 5),
good AS (SELECT * FROM raw WHERE NOT (station_complex_id = '3' AND transit_mode = 'tram'))
"""



def _shipped(series: str, name: str, mode: str) -> str:
    return f"""
raw AS (
  SELECT l.l_shipdate AS transit_timestamp, {mode} AS transit_mode, CAST({series} AS VARCHAR) AS station_complex_id,
    {name} AS station_complex, r.r_name AS borough,
    CAST(l.l_quantity AS BIGINT) AS ridership, CAST(l.l_linenumber AS BIGINT) AS transfers
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey),
good AS (SELECT * FROM raw)
"""


DAILY_RAW = _shipped("n.n_nationkey", "n.n_name", "r.r_name")
SUPPLIER_RAW = _shipped("s.s_suppkey", "s.s_name", "n.n_name")

STATION = "station_complex_id, station_complex, borough, transit_mode"
KEYS = f"{STATION}, transit_timestamp"


def _prep(step: str) -> str:
    return f"""
sums AS (
  SELECT {KEYS}, CAST(sum(ridership) AS BIGINT) AS entries, CAST(sum(transfers) AS BIGINT) AS transfers
  FROM good GROUP BY {KEYS}),
steps AS (
  SELECT unnest(generate_series(min(transit_timestamp), max(transit_timestamp), INTERVAL 1 {step})) AS transit_timestamp
  FROM raw),
grid AS (
  SELECT {KEYS}, coalesce(entries, 0) AS entries, coalesce(transfers, 0) AS transfers
  FROM (SELECT DISTINCT {STATION} FROM sums) CROSS JOIN steps LEFT JOIN sums USING ({KEYS})),
clipped AS (SELECT {KEYS}, greatest(entries, 0) AS entries, greatest(transfers, 0) AS transfers FROM grid),
ordered AS (
  SELECT station_complex_id, entries,
    row_number() OVER (PARTITION BY station_complex_id ORDER BY entries) - 1 AS i,
    count(*) OVER (PARTITION BY station_complex_id) AS n
  FROM clipped),
quartiles AS (
  SELECT station_complex_id,
    CAST(max(CASE WHEN i = floor((n - 1) * 0.25 + 0.5) THEN entries END) AS DOUBLE) AS q1,
    CAST(max(CASE WHEN i = floor((n - 1) * 0.75 + 0.5) THEN entries END) AS DOUBLE) AS q3
  FROM ordered GROUP BY station_complex_id)
"""


CAPPED = f"""
caps AS (
  SELECT station_complex_id, q1, q3, q3 - q1 AS iqr, CAST(q3 + 3.0 * (q3 - q1) AS DOUBLE) AS upper_cap FROM quartiles),
cleaned AS (
  SELECT {KEYS}, CAST(round(CASE WHEN entries > upper_cap THEN upper_cap ELSE entries END) AS BIGINT) AS entries,
    transfers
  FROM clipped JOIN caps USING (station_complex_id))
"""


def _history(source: str, lags: tuple[int, ...], windows: tuple[int, ...], suffix: str) -> str:
    parts = [f"lag(entries, {k}) OVER w AS lag_{k}{suffix}" for k in lags]
    for n in windows:
        frame = f"OVER (PARTITION BY station_complex_id ORDER BY transit_timestamp ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        parts.append(
            f"CASE WHEN count(entries) {frame} = {n} THEN avg(entries) {frame} END AS rolling_mean_{n}{suffix}"
        )
    return f"""
history AS (
  SELECT {KEYS}, entries, transfers, {', '.join(parts)}
  FROM {source} WINDOW w AS (PARTITION BY station_complex_id ORDER BY transit_timestamp)),
features AS (
  SELECT * EXCLUDE (transfers), CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
    CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week,
    CAST(month(transit_timestamp) AS INTEGER) AS month, isodow(transit_timestamp) >= 6 AS is_weekend
  FROM history WHERE lag_{max(lags)}{suffix} IS NOT NULL)
"""


HOURLY_CUTS = ("2024-01-26 00:00:00", "2024-01-28 12:00:00")
DAILY_CUTS = ("2000-06-01 00:00:00", "2001-02-01 00:00:00")


def _split(cuts: tuple[str, str], naive: str, rolling: str, rolling_name: str) -> str:
    return f"""
labelled AS (
  SELECT *, CASE WHEN transit_timestamp < TIMESTAMP '{cuts[0]}' THEN 'train'
                 WHEN transit_timestamp < TIMESTAMP '{cuts[1]}' THEN 'val' ELSE 'test' END AS split
  FROM features),
predictions AS (
  SELECT {KEYS}, entries, CAST({naive} AS DOUBLE) AS pred_naive, {rolling} AS pred_{rolling_name}
  FROM labelled WHERE split = 'test'),
long AS (
  SELECT {KEYS}, entries, 'naive' AS model, pred_naive AS p FROM predictions
  UNION ALL SELECT {KEYS}, entries, '{rolling_name}', pred_{rolling_name} FROM predictions)
"""


HOURLY_SUMS = [HOURLY_RAW, _prep("HOUR")]
HOURLY_CLEAN = [*HOURLY_SUMS, CAPPED]
HOURLY_FEATURES = [*HOURLY_CLEAN, _history("cleaned", (1, 24, 168), (3, 24), "h")]
HOURLY_SPLIT = [*HOURLY_FEATURES, _split(HOURLY_CUTS, "lag_168h", "rolling_mean_24h", "rolling_avg_24h")]
DAILY_CLEAN = [DAILY_RAW, _prep("DAY"), CAPPED]
DAILY_FEATURES = [*DAILY_CLEAN, _history("cleaned", (1, 7, 28), (3, 7), "d")]
DAILY_SPLIT = [*DAILY_FEATURES, _split(DAILY_CUTS, "lag_28d", "rolling_mean_7d", "rolling_avg_7d")]


def _rounded(columns: str) -> str:
    return f"* REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in columns.split())})"


HOURLY_ROLLING = _rounded("rolling_mean_3h rolling_mean_24h")
LABELLED_ROLLING = HOURLY_ROLLING.replace("* REPLACE", "* EXCLUDE (split) REPLACE")


def _with(parts: list[str], query: str) -> str:
    return f"WITH {','.join(parts)} {query}"


ERRORS = "round(avg(abs(entries - p)), 6) AS mae, round(sqrt(avg((entries - p) * (entries - p))), 6) AS rmse"

DATE_TOTALS = """SELECT CAST(transit_timestamp AS DATE) AS date, CAST(sum(entries) AS BIGINT) AS total_entries,
  count(*) AS n_rows FROM cleaned GROUP BY 1"""

def _quiet_days(limit: float = 4.0, weeks: int = 4) -> str:
    return f"""
days AS (SELECT * FROM ({DATE_TOTALS}) WHERE n_rows = (SELECT max(n_rows) FROM ({DATE_TOTALS}))),
sorted AS (
  SELECT a.date, any_value(a.total_entries) AS total_entries, list_sort(list(b.total_entries)) AS near
  FROM days a JOIN days b ON abs(date_diff('day', a.date, b.date)) <= {7 * weeks} AND isodow(a.date) = isodow(b.date)
  GROUP BY a.date),
usual AS (SELECT date, total_entries, near[(len(near) + 1) // 2] AS usual_entries FROM sorted),
deviations AS (
  SELECT *, CASE WHEN usual_entries <> 0 THEN (total_entries - usual_entries) / usual_entries::DOUBLE END AS deviation FROM usual),
scores AS (
  SELECT *, coalesce(abs(deviation) > {limit}::DOUBLE * greatest(1.4826::DOUBLE
      * (SELECT median(abs(deviation)) FROM deviations), 0.01::DOUBLE), false) AS unusual FROM deviations)
"""


def _quiet_cut(cut: str, ahead: int) -> str:
    return f"""SELECT TIMESTAMP '{cut}' AS proposed, coalesce(CAST(min(s.date) AS TIMESTAMP), TIMESTAMP '{cut}') AS train_end
  FROM scores s WHERE s.date >= TIMESTAMP '{cut}' AND NOT EXISTS (SELECT 1 FROM scores u
    WHERE u.unusual AND u.date >= s.date AND date_diff('day', s.date, u.date) < {ahead})"""


DAILY_VALIDATION = f"""SELECT {_rounded('rolling_mean_3d rolling_mean_7d').replace('* REPLACE', '* EXCLUDE (split) REPLACE')}
  FROM labelled WHERE split = 'val'"""
DAY_SCORES = "SELECT * REPLACE (round(deviation, 6) AS deviation) FROM scores"
SKETCHED = "SELECT station_complex_id, q1, q3, true AS q1_within, true AS q3_within FROM caps"
PROFILE = """SELECT count(*) AS n_rows, min(transit_timestamp) AS min_ts, max(transit_timestamp) AS max_ts,
  count(*) FILTER (transit_timestamp IS NULL) AS n_ts_parse_fail,
  count(DISTINCT station_complex_id) AS n_stations FROM raw"""
SUMMARY = "count(*) AS n_rows, count(DISTINCT station_complex_id) AS n_stations"
WEEKEND = "isodow(transit_timestamp) >= 6"
VOLATILITY = """SELECT {key}, round(avg(entries), 6) AS avg_entries, round(stddev_samp(entries), 6) AS std_entries,
  round(CASE WHEN avg(entries) <> 0 THEN stddev_samp(entries) / avg(entries) END, 6) AS cv FROM cleaned GROUP BY {key}"""
HOUR_PIVOT = ", ".join(
    f"round(avg(entries) FILTER (hour(transit_timestamp) = {h}), 6) AS h{h:02d}" for h in range(24)
)
CAPS = "SELECT station_complex_id, q1, q3, iqr, upper_cap FROM caps"
SPLIT_COUNTS = """SELECT split, count(*) AS n_rows, min(transit_timestamp) AS min_ts, max(transit_timestamp) AS max_ts,
  round(count(*) * 100.0 / (SELECT count(*) FROM labelled), 1) AS pct FROM labelled GROUP BY split"""

QUALITY = """SELECT count(*) AS n_rows,
  count(*) FILTER (entries < 0) AS n_negative_entries, count(*) FILTER (transfers < 0) AS n_negative_transfers,
  count(*) FILTER (greatest(entries, 0) > upper_cap) AS n_capped,
  round(count(*) FILTER (greatest(entries, 0) > upper_cap) * 100.0 / count(*), 4) AS pct_capped
  FROM grid JOIN caps USING (station_complex_id)"""
LINEAGE = """SELECT (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM sums) AS n_station_step,
  count(*) AS n_grid, count(*) - (SELECT count(*) FROM sums) AS n_gaps_filled FROM grid"""
TOTAL = "SELECT {key}, CAST(sum(entries) AS BIGINT) AS total_entries FROM cleaned GROUP BY 1"

SPLIT_CHECK = _with(HOURLY_SPLIT, """SELECT
        min(transit_timestamp) FILTER (split = 'train') AS train_first,
        max(transit_timestamp) FILTER (split = 'train') AS train_last,
        min(transit_timestamp) FILTER (split = 'val') AS val_first,
        max(transit_timestamp) FILTER (split = 'val') AS val_last,
        min(transit_timestamp) FILTER (split = 'test') AS test_first,
        max(transit_timestamp) FILTER (split = 'test') AS test_last,
        max(transit_timestamp) FILTER (split = 'train') < min(transit_timestamp) FILTER (split = 'val')
        AND max(transit_timestamp) FILTER (split = 'val') < min(transit_timestamp) FILTER (split = 'test')
        AS chronological FROM labelled""")
BEST_TRIAL = """SELECT num_leaves, max_depth, learning_rate, n_estimators, min_data_in_leaf, feature_fraction, bagging_fraction
  FROM (SELECT CAST(l_partkey % 50 AS INT) AS trial, CAST(max(l_linenumber) AS INT) AS num_leaves,
          CAST(min(l_linenumber) AS INT) AS max_depth, CAST(max(l_discount) AS DOUBLE) AS learning_rate,
          CAST(count(*) % 97 AS INT) AS n_estimators, CAST(max(l_quantity) AS INT) AS min_data_in_leaf,
          CAST(max(l_tax) AS DOUBLE) AS feature_fraction, CAST(min(l_tax) AS DOUBLE) AS bagging_fraction,
          round(avg(l_quantity), 3) AS val_mae FROM lineitem GROUP BY 1)
  ORDER BY val_mae, trial LIMIT 1"""


def _boosted(numeric: list[str], text: list[str], trees: int, leaves: int, rate: float, least: int) -> list[str]:
    """Best-first trees as SQL: each split is the best one of all leaves. Ends with `fitted` (score s) and `gains`."""
    names = [*numeric, *text]
    parts = [f"""b0 AS MATERIALIZED (
      SELECT {", ".join([f"{c}::DOUBLE AS {c}" for c in numeric] + text)}, entries::DOUBLE AS y, avg(entries) OVER () AS s
      FROM labelled WHERE split <> 'test')"""]
    for t in range(1, trees + 1):
        parts.append(f"t{t}_0 AS MATERIALIZED (SELECT *, y - s AS r, 0 AS leaf FROM b{t - 1})")
        for k in range(1, leaves):
            now, new = f"t{t}_{k - 1}", f"t{t}_{k}"
            cells = " UNION ALL ".join(
                f"SELECT leaf, {i} AS f, {c if c in numeric else 'avg(r)'} AS x, {'NULL' if c in numeric else c} AS v, "
                f"count(*)::DOUBLE AS n, sum(r) AS g FROM {now} GROUP BY leaf, {c}"
                for i, c in enumerate(names)
            )
            goes = " ".join(
                f"WHEN {i} THEN {f'{c} <= p.x' if c in numeric else f'list_contains((SELECT vs FROM l{new}), {c})'}"
                for i, c in enumerate(names)
            )
            parts += [
                f"c{new} AS MATERIALIZED ({cells})",
                f"""w{new} AS (SELECT *, sum(n) OVER u AS ln, sum(g) OVER u AS lg, sum(n) OVER a AS an, sum(g) OVER a AS ag
                  FROM c{new} WINDOW u AS (PARTITION BY leaf, f ORDER BY x, v), a AS (PARTITION BY leaf, f))""",
                f"""p{new} AS MATERIALIZED (
                  SELECT leaf AS at, f, x, v, lg * lg / ln + (ag - lg) * (ag - lg) / (an - ln) - ag * ag / an AS gain FROM w{new}
                  WHERE ln >= {least} AND an - ln >= {least} ORDER BY gain DESC, f, x LIMIT 1)""",
                f"""l{new} AS MATERIALIZED (SELECT list(c.v) AS vs FROM c{new} c JOIN p{new} p ON c.leaf = p.at AND c.f = p.f
                  WHERE c.x < p.x OR c.x = p.x AND c.v <= p.v)""",
                f"""{new} AS MATERIALIZED (SELECT t.* REPLACE (
                  CASE WHEN leaf = p.at AND NOT CASE p.f {goes} END THEN {k} ELSE leaf END AS leaf) FROM {now} t CROSS JOIN p{new} p)""",
            ]
        value = f"s + {rate}::DOUBLE * avg(r) OVER (PARTITION BY leaf)"
        parts.append(f"b{t} AS MATERIALIZED (SELECT {', '.join(names)}, y, {value} AS s FROM t{t}_{leaves - 1})")
    found = " UNION ALL ".join(f"SELECT f, gain FROM pt{t}_{k}" for t in range(1, trees + 1) for k in range(1, leaves))
    return [*parts, f"gains AS ({found})", f"fitted AS (SELECT * FROM b{trees})"]


FEW = (["hour_of_day", "day_of_week", "month"], ["station_complex"])
FEW_SCORES = (
    "SELECT DISTINCT hour_of_day::INT AS hour_of_day, day_of_week::INT AS day_of_week, month::INT AS month, station_complex, "
    "round(s, 6) AS pred_model FROM fitted"
)


def _next_draws(draws: int) -> str:
    """Kernel densities of the good and the other trials at candidates around the good ones."""
    scaled = {
        "num_leaves": "(num_leaves - 15) / 240.0::DOUBLE",
        "learning_rate": "(ln(learning_rate) - ln(0.01::DOUBLE)) / (ln(0.3::DOUBLE) - ln(0.01::DOUBLE))",
        "feature_fraction": "(feature_fraction - 0.5::DOUBLE) / 0.5::DOUBLE",
    }
    points = " UNION ALL ".join(f"SELECT '{c}' AS name, good, size, {u} AS u FROM ranked" for c, u in scaled.items())
    width = "(pow(size + 1, -0.2::DOUBLE) / 4)"
    offsets = "[-1.6, -1.0, -0.6, -0.3, -0.1, 0.1, 0.3, 0.6, 1.0, 1.6]::DOUBLE[]"
    density = "(coalesce(sum(k) FILTER ({0}), 0) + 1) / (count(*) FILTER ({0}) + 1)"
    return f"""
WITH log AS (
  SELECT CAST(l_partkey % 50 AS INT) AS trial, sum(l_linenumber) % 241 + 15 AS num_leaves,
         exp(-4.6::DOUBLE + (sum(l_suppkey) % 34)::DOUBLE / 10) AS learning_rate,
         0.5::DOUBLE + (sum(l_orderkey) % 51)::DOUBLE / 100 AS feature_fraction, round(avg(l_quantity), 3) AS val_mae
  FROM lineitem GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY val_mae, trial) <= ceil(count(*) OVER () * 0.25::DOUBLE) AS good FROM log),
ranked AS (SELECT *, count(*) OVER (PARTITION BY good) AS size FROM placed),
points AS ({points}),
places AS (SELECT DISTINCT name, greatest(least(u + {width} * unnest({offsets}), 1), 0) AS c FROM points WHERE good),
kernels AS (
  SELECT name, c, good, exp(-pow((c - u) / {width}, 2) / 2) / ({width} * sqrt(2 * pi())) AS k FROM places JOIN points USING (name)),
ratios AS (
  SELECT name, c, round(ln({density.format("good")}) - ln({density.format("NOT good")}), 9) AS ratio FROM kernels GROUP BY name, c),
best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ratio DESC, c) AS draw FROM ratios)
SELECT draw::INT AS draw, round(15 + max(c) FILTER (name = 'num_leaves') * 240)::INT AS num_leaves,
       round(exp(ln(0.01::DOUBLE) + max(c) FILTER (name = 'learning_rate') * (ln(0.3::DOUBLE) - ln(0.01::DOUBLE))), 6) AS learning_rate,
       round(0.5::DOUBLE + max(c) FILTER (name = 'feature_fraction') * 0.5::DOUBLE, 6) AS feature_fraction
FROM best WHERE draw <= {draws} GROUP BY draw"""


ORACLE: dict[str, str] = {
    "profile_raw": _with([HOURLY_RAW], PROFILE),
    "parsed_times": """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed
        FROM events""",
    "profile_rollup": _with([HOURLY_RAW], PROFILE),
    "exclude_rows": _with([HOURLY_RAW], "SELECT * EXCLUDE (latitude, longitude) FROM good"),
    "station_hour": _with(HOURLY_SUMS, "SELECT * FROM sums"),
    "raw_csv_roundtrip": _with(HOURLY_SUMS, "SELECT * FROM sums"),
    "station_locations": _with([HOURLY_RAW], f"""SELECT {STATION}, round(avg(latitude), 6) AS latitude,
        round(avg(longitude), 6) AS longitude FROM good GROUP BY {STATION}"""),
    "location_points": _with([HOURLY_RAW], f"""SELECT station_complex_id, round(avg(longitude), 4) AS longitude,
        round(avg(latitude), 4) AS latitude FROM good GROUP BY {STATION}"""),
    "reindexed": _with(HOURLY_SUMS, "SELECT * FROM grid"),
    "off_grid_rows": _with(HOURLY_SUMS, """SELECT count(*) AS n_off_grid,
        CAST(coalesce(sum(entries), 0) AS BIGINT) AS lost_entries
        FROM sums WHERE transit_timestamp IS NULL OR transit_timestamp NOT IN (SELECT transit_timestamp FROM steps)"""),
    "ambiguous_series": _with([HOURLY_RAW], f"""SELECT station_complex_id, count(*) AS n_tuples
        FROM (SELECT DISTINCT {STATION} FROM raw) GROUP BY station_complex_id HAVING count(*) > 1"""),
    "quality_counts": _with(HOURLY_CLEAN, QUALITY),
    "stage_counts": _with(HOURLY_FEATURES, f"""SELECT 0 AS seq, 'station_hour' AS stage, {SUMMARY} FROM sums
        UNION ALL SELECT 1, 'cleaned', {SUMMARY} FROM cleaned UNION ALL SELECT 2, 'features', {SUMMARY} FROM features"""),
    "lineage": _with(HOURLY_SUMS, LINEAGE),
    "iqr_caps": _with(HOURLY_CLEAN, CAPS),
    "iqr_caps_of_grid": _with(HOURLY_CLEAN, CAPS),
    "cap_outliers": _with(HOURLY_CLEAN, "SELECT * FROM cleaned"),
    "cleaned": _with(HOURLY_CLEAN, "SELECT * FROM cleaned"),
    "table_summary": _with(HOURLY_CLEAN, f"""SELECT {SUMMARY}, min(transit_timestamp) AS min_ts,
        max(transit_timestamp) AS max_ts FROM cleaned"""),
    "lags": _with(HOURLY_FEATURES, f"SELECT {KEYS}, entries, transfers, lag_1h, lag_24h, lag_168h FROM history"),
    "rolling": _with(
        HOURLY_FEATURES, f"""SELECT {KEYS}, entries, transfers, round(rolling_mean_3h, 6) AS rolling_mean_3h,
        round(rolling_mean_24h, 6) AS rolling_mean_24h FROM history"""
    ),
    "features": _with(HOURLY_FEATURES, f"SELECT {HOURLY_ROLLING} FROM features"),
    "features_by_row": _with(
        [*HOURLY_SUMS, _history("sums", (1, 24, 168), (3, 24), "h")], f"SELECT {HOURLY_ROLLING} FROM features"
    ),
    "features_range": _with(HOURLY_SPLIT, f"SELECT {LABELLED_ROLLING} FROM labelled WHERE split = 'val'"),
    "split_counts": _with(HOURLY_SPLIT, SPLIT_COUNTS),
    "split_check": SPLIT_CHECK,
    "split_check_of_parts": SPLIT_CHECK,
    "proportional_cuts": _with(HOURLY_FEATURES, """SELECT *,
        min_ts + to_hours(CAST(floor(round(total_steps * 0.8, 6)) AS BIGINT)) AS train_end,
        min_ts + to_hours(CAST(floor(round(total_steps * 0.9, 6)) AS BIGINT)) AS validation_end
        FROM (SELECT min(transit_timestamp) AS min_ts, max(transit_timestamp) AS max_ts,
          date_diff('hour', min(transit_timestamp), max(transit_timestamp)) + 1 AS total_steps FROM features)"""),
    "daily_totals": _with(HOURLY_CLEAN, DATE_TOTALS),
    "train_val_union": _with(HOURLY_SPLIT, f"SELECT {LABELLED_ROLLING} FROM labelled WHERE split IN ('train', 'val')"),
    "baseline_predictions": _with(HOURLY_SPLIT, "SELECT * REPLACE (round(pred_rolling_avg_24h, 6) AS pred_rolling_avg_24h) FROM predictions"),
    "attach_predictions": _with(HOURLY_SPLIT, """SELECT * EXCLUDE (split)
        REPLACE (round(rolling_mean_3h, 6) AS rolling_mean_3h, round(rolling_mean_24h, 6) AS rolling_mean_24h),
        CAST(lag_168h AS DOUBLE) AS pred_naive, round(rolling_mean_24h, 6) AS pred_rolling_avg_24h
        FROM labelled WHERE split = 'test'"""),
    "evaluate": _with(HOURLY_SPLIT, f"SELECT {ERRORS} FROM long WHERE model = 'naive'"),
    "baseline_metrics": _with(HOURLY_SPLIT, f"SELECT model, {ERRORS} FROM long GROUP BY model"),
    "baseline_by_station": _with(
        HOURLY_SPLIT, f"SELECT station_complex, model, {ERRORS} FROM long GROUP BY station_complex, model"
    ),
    "improvement": _with(HOURLY_SPLIT, """SELECT 'rolling_avg_24h' AS model, 'naive' AS reference,
        round((1 - avg(abs(entries - pred_rolling_avg_24h)) / avg(abs(entries - pred_naive))) * 100, 6) AS improvement_pct
        FROM predictions"""),
    "slice_metrics": _with(HOURLY_SPLIT, f"""SELECT model, {ERRORS} FROM long WHERE station_complex = 'S0'
        AND CAST(transit_timestamp AS DATE) BETWEEN DATE '2024-01-29' AND DATE '2024-01-30' GROUP BY model"""),
    "hourly_profile": _with(HOURLY_CLEAN, f"""SELECT CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
        {WEEKEND} AS is_weekend, round(avg(entries), 6) AS avg_entries,
        CASE WHEN {WEEKEND} THEN 'Weekend' ELSE 'Weekday' END AS category FROM cleaned GROUP BY 1, 2, 4"""),
    "hourly_mean": _with(HOURLY_CLEAN, """SELECT CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
        round(avg(entries), 6) AS avg_entries FROM cleaned GROUP BY 1"""),
    "weekday_hour_pivot": _with(HOURLY_CLEAN, f"""SELECT CAST(isodow(transit_timestamp) - 1 AS INTEGER) AS day_of_week,
        CASE isodow(transit_timestamp) WHEN 1 THEN 'Senin' WHEN 2 THEN 'Selasa' WHEN 3 THEN 'Rabu' WHEN 4 THEN 'Kamis'
        WHEN 5 THEN 'Jumat' WHEN 6 THEN 'Sabtu' ELSE 'Minggu' END AS day_name, {HOUR_PIVOT}
        FROM cleaned GROUP BY 1, 2"""),
    "weekday_ratio": _with(HOURLY_CLEAN, f"""SELECT round(avg(entries) FILTER (NOT {WEEKEND}), 6) AS weekday_mean,
        round(avg(entries) FILTER ({WEEKEND}), 6) AS weekend_mean,
        round(avg(entries) FILTER (NOT {WEEKEND}) / avg(entries) FILTER ({WEEKEND}), 6) AS ratio FROM cleaned"""),
    "top_stations": _with(HOURLY_CLEAN, TOTAL.format(key="station_complex") + " ORDER BY 2 DESC, 1 LIMIT 20"),
    "top_stations_by_id": _with(HOURLY_CLEAN, TOTAL.format(key="station_complex_id") + " ORDER BY 2 DESC, 1 LIMIT 8"),
    "borough_totals": _with(HOURLY_CLEAN, TOTAL.format(key="borough")),
    "busiest_station": _with(HOURLY_CLEAN, TOTAL.format(key="station_complex") + " ORDER BY 2 DESC, 1 LIMIT 1"),
    "station_list": _with(HOURLY_CLEAN, "SELECT DISTINCT station_complex FROM cleaned"),
    "volatility": _with(HOURLY_CLEAN, VOLATILITY.format(key="station_complex")),
    "volatile_stations": _with(
        HOURLY_CLEAN,
        VOLATILITY.format(key="station_complex") + " HAVING avg(entries) > 0 AND stddev_samp(entries) / avg(entries) > 1.3",
    ),
    "summary": _with(HOURLY_CLEAN, f"""SELECT CASE WHEN {WEEKEND} THEN 'weekend' ELSE 'weekday' END AS section,
          lpad(CAST(hour(transit_timestamp) AS VARCHAR), 2, '0') AS label, '' AS series_id, round(avg(entries), 1) AS value
        FROM cleaned GROUP BY 1, 2
        UNION ALL SELECT * FROM (SELECT 'top_stations', station_complex, station_complex_id, round(sum(entries) / 1000.0::DOUBLE, 1)
          FROM cleaned GROUP BY 2, 3 ORDER BY sum(entries) DESC, station_complex_id LIMIT 8)
        UNION ALL SELECT 'boroughs', borough, '', round(sum(entries) / 1000.0::DOUBLE, 0) FROM cleaned GROUP BY 2"""),
    "station_hourly": _with(HOURLY_CLEAN, """SELECT station_complex, CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day,
        round(avg(entries), 6) AS avg_entries FROM cleaned GROUP BY 1, 2"""),
    "peak_hours": _with(HOURLY_CLEAN, """SELECT station_complex, hour_of_day AS peak_hour, round(a, 6) AS peak_avg_entries
        FROM (SELECT station_complex, CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day, avg(entries) AS a
              FROM cleaned GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY station_complex ORDER BY a DESC, hour_of_day) = 1"""),
    "map_table": _with(HOURLY_CLEAN, f"""SELECT {STATION}, latitude, longitude, total_entries
        FROM (SELECT {STATION}, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
              FROM good GROUP BY {STATION})
        LEFT JOIN (SELECT station_complex, CAST(sum(entries) AS BIGINT) AS total_entries FROM cleaned GROUP BY 1)
        USING (station_complex)"""),
    "date_bounds": _with(HOURLY_SPLIT, """SELECT CAST(min(transit_timestamp) AS DATE) AS min_date,
        CAST(max(transit_timestamp) AS DATE) AS max_date FROM predictions"""),
    "station_slice": _with(HOURLY_CLEAN, """SELECT * FROM cleaned WHERE station_complex = 'S0'
        AND transit_timestamp >= TIMESTAMP '2024-01-10' AND transit_timestamp < TIMESTAMP '2024-01-21'"""),
    "crowding_alerts": _with(HOURLY_SPLIT, f"""SELECT {KEYS}, hour_of_day, pred_naive, round(u, 6) AS usual_entries,
        round(pred_naive / u - 1, 6) AS above_usual
        FROM (SELECT *, CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day FROM predictions)
        JOIN (SELECT station_complex_id, CAST(hour(transit_timestamp) AS INTEGER) AS hour_of_day, avg(entries) AS u
              FROM cleaned GROUP BY 1, 2) USING (station_complex_id, hour_of_day)
        WHERE u > 0 AND pred_naive / u - 1 >= 0.30"""),
    "baseline_series": _with(HOURLY_SPLIT, f"""SELECT station_complex, station_complex_id, transit_timestamp, series,
        round(value, 6) AS value
        FROM (SELECT {KEYS}, 'actual' AS series, CAST(entries AS DOUBLE) AS value FROM predictions
              UNION ALL SELECT {KEYS}, model, p FROM long)
        WHERE station_complex = (SELECT station_complex FROM predictions GROUP BY 1
                                 ORDER BY sum(entries) DESC, station_complex LIMIT 1)"""),
    "raw_losses": """SELECT count(*) AS n_rows, 0::BIGINT AS n_damaged_rows, 0::BIGINT AS n_without_time,
          count(*) FILTER (t IS NULL) AS n_ridership_missing, count(*) FILTER (t = 'n/a') AS n_ridership_unreadable,
          0::BIGINT AS n_transfers_missing, 0::BIGINT AS n_transfers_unreadable,
          CAST(sum(CASE WHEN t = 'n/a' THEN NULL WHEN t = 'k' THEN v * 1000 WHEN t IS NOT NULL THEN v END) AS BIGINT) AS total_read
        FROM (SELECT CAST(round(value) AS BIGINT) AS v, CASE WHEN event_id % 13 = 1 THEN 'n/a' WHEN event_id % 17 = 2 THEN NULL
                WHEN event_id % 10 = 3 THEN '.0' WHEN event_id % 10 = 4 THEN 'k' ELSE '' END AS t FROM events)""",
    "gbt_encoding": _with([*HOURLY_SPLIT, """
fit AS (SELECT * FROM labelled WHERE split <> 'test'),
prior AS (SELECT avg(entries) AS p FROM fit)"""], "SELECT " + KEYS + ", " + ", ".join(
        f"""round((SELECT (sum(f.entries) + 20.0::DOUBLE * any_value(p)) / (count(*) + 20.0::DOUBLE) FROM fit f CROSS JOIN prior
        WHERE f.{c} = labelled.{c}), 6) AS {c}_mean""" for c in ("station_complex", "borough", "transit_mode")
    ) + " FROM labelled WHERE split = 'test'"),
    "gbt_encoding_of_many": """WITH o AS (SELECT o_custkey::VARCHAR AS station_complex, o_orderpriority AS borough,
          o_orderstatus AS transit_mode, floor(o_totalprice)::BIGINT AS entries FROM orders),
        long AS (SELECT 'station_complex' AS feature, station_complex AS value, entries FROM o
          UNION ALL SELECT 'borough', borough, entries FROM o UNION ALL SELECT 'transit_mode', transit_mode, entries FROM o)
        SELECT feature, value, round((sum(entries) + 20.0::DOUBLE * (SELECT avg(entries) FROM o)) / (count(*) + 20.0::DOUBLE), 4) AS mean
        FROM long GROUP BY feature, value""",
    "gbt_stump": _with([*HOURLY_SPLIT, """
fit AS (SELECT hour_of_day, day_of_week, month, is_weekend, entries FROM labelled WHERE split <> 'test'),
calendar AS (
  SELECT 'hour_of_day' AS f, hour_of_day::INT AS x, entries FROM fit UNION ALL SELECT 'day_of_week', day_of_week, entries FROM fit
  UNION ALL SELECT 'month', month, entries FROM fit UNION ALL SELECT 'is_weekend', is_weekend::INT, entries FROM fit),
cells AS (SELECT f, x, count(*)::DOUBLE AS n, sum(entries)::DOUBLE AS s FROM calendar GROUP BY f, x),
cuts AS (
  SELECT f, x, sum(n) OVER u AS n, sum(s) OVER u AS s, sum(n) OVER a AS n_all, sum(s) OVER a AS s_all
  FROM cells WINDOW u AS (PARTITION BY f ORDER BY x), a AS (PARTITION BY f)),
best AS (
  SELECT f, x, s / n AS low, (s_all - s) / (n_all - n) AS high FROM cuts WHERE n < n_all
  ORDER BY s * s / n + (s_all - s) * (s_all - s) / (n_all - n) DESC LIMIT 1)"""],
        """SELECT DISTINCT hour_of_day, day_of_week, month, is_weekend, round(CASE WHEN
            CASE f WHEN 'hour_of_day' THEN hour_of_day WHEN 'day_of_week' THEN day_of_week WHEN 'month' THEN month
              ELSE is_weekend::INT END <= x THEN low ELSE high END, 6) AS pred_model FROM fit CROSS JOIN best"""),
    "gbt_leafwise": _with([*HOURLY_SPLIT, *_boosted(*FEW, 1, 8, 1.0, 20)], FEW_SCORES),
    "gbt_boosted": _with([*HOURLY_SPLIT, *_boosted(*FEW, 3, 4, 0.3, 20)], FEW_SCORES),
    "gbt_category_set": _with([*HOURLY_SPLIT, *_boosted([], ["station_complex"], 1, 2, 1.0, 1)],
        "SELECT DISTINCT station_complex, round(s, 6) AS pred_model FROM fitted"),
    "gbt_gain": _with([*HOURLY_SPLIT, *_boosted(*FEW, 3, 4, 0.3, 20)], """SELECT name AS feature, round(coalesce(sum(gain), 0), 0) AS importance
        FROM (SELECT unnest(['hour_of_day', 'day_of_week', 'month', 'station_complex']) AS name, unnest(range(4)) AS f)
        LEFT JOIN gains USING (f) GROUP BY name"""),
    "gbt_tree_table": _with([*HOURLY_SPLIT, *_boosted(*FEW, 1, 8, 1.0, 20)],
        "SELECT count(*) AS n_rows, round(avg(r), 4) AS value FROM t1_7 GROUP BY leaf"),
    "gbt_next_draws": _next_draws(3),
    "gbt_prediction_rows": _with(HOURLY_SPLIT, """SELECT * REPLACE (round(pred_rolling_avg_24h, 6) AS pred_rolling_avg_24h),
        true AS predicted FROM predictions"""),
    "gbt_best_trial": BEST_TRIAL,
    "stored_params": BEST_TRIAL,
    "gbt_early_stop": """WITH c AS (
          SELECT o_orderstatus, round(avg(o_totalprice), 2) AS e,
            row_number() OVER (PARTITION BY o_orderstatus ORDER BY date_trunc('month', o_orderdate)) AS i
          FROM orders GROUP BY o_orderstatus, date_trunc('month', o_orderdate)),
        r AS (SELECT *, min(e) OVER (PARTITION BY o_orderstatus ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM c),
        b AS (SELECT o_orderstatus, i, lead(i) OVER (PARTITION BY o_orderstatus ORDER BY i) AS next FROM r WHERE m IS NULL OR e < m)
        SELECT o_orderstatus, CAST(min(i) AS INT) AS best_iteration FROM b WHERE next IS NULL OR next - i > 10 GROUP BY 1""",
    "stored_features": _with(HOURLY_SPLIT, f"SELECT {KEYS}, entries FROM labelled WHERE split = 'test'"),
    "stored_metrics": _with(HOURLY_SPLIT, f"SELECT model, {ERRORS} FROM long GROUP BY model"),
    "stored_model": _with(HOURLY_SPLIT, "SELECT count(*) AS n_rows, 0::BIGINT AS n_changed FROM predictions"),
    "supplier_lineage": _with([SUPPLIER_RAW, _prep("DAY")], LINEAGE),
    "supplier_grid_totals": _with([SUPPLIER_RAW, _prep("DAY")], """SELECT station_complex_id, count(*) AS n_days,
        count(*) FILTER (entries = 0) AS n_empty, CAST(sum(entries) AS BIGINT) AS total_entries FROM grid GROUP BY 1"""),
    "supplier_features": _with(
        [SUPPLIER_RAW, _prep("DAY"), CAPPED, _history("cleaned", (1, 7, 28), (3, 7), "d")],
        """SELECT station_complex_id, count(*) AS n_rows, CAST(sum(entries) AS BIGINT) AS total_entries,
        CAST(sum(lag_28d) AS BIGINT) AS total_lag, round(sum(rolling_mean_7d), 3) AS total_mean FROM features GROUP BY 1""",
    ),
    "monthly_updated": _with(DAILY_FEATURES, f"SELECT {_rounded('rolling_mean_3d rolling_mean_7d')} FROM features"),
    "monthly_caps": _with(DAILY_CLEAN, "SELECT station_complex_id, upper_cap FROM caps"),
    "monthly_range": _with(DAILY_SPLIT, DAILY_VALIDATION),
    "monthly_computed_range": _with(DAILY_SPLIT, DAILY_VALIDATION),
    "sketch_caps": _with(HOURLY_CLEAN, SKETCHED),
    "daily_sketch_caps": _with(DAILY_CLEAN, SKETCHED),
    "unusual_days": _with([*HOURLY_CLEAN, _quiet_days()], DAY_SCORES),
    "daily_unusual_days": _with([*DAILY_CLEAN, _quiet_days()], DAY_SCORES),
    "quiet_cut": _with([*HOURLY_CLEAN, _quiet_days()], _quiet_cut(HOURLY_CUTS[1], 2)),
    "daily_quiet_cut": _with([*DAILY_CLEAN, _quiet_days()], _quiet_cut("2000-04-21 00:00:00", 7)),
    "daily_station_day": _with([DAILY_RAW, _prep("DAY")], "SELECT * FROM sums"),
    "daily_caps": _with(DAILY_CLEAN, CAPS),
    "daily_cleaned": _with(DAILY_CLEAN, "SELECT * FROM cleaned"),
    "daily_features": _with(DAILY_FEATURES, f"SELECT {_rounded('rolling_mean_3d rolling_mean_7d')} FROM features"),
    "daily_baseline_metrics": _with(DAILY_SPLIT, f"SELECT model, {ERRORS} FROM long GROUP BY model"),
    "daily_baseline_by_station": _with(
        DAILY_SPLIT, f"SELECT station_complex_id, model, {ERRORS} FROM long GROUP BY station_complex_id, model"
    ),
    "daily_quality_counts": _with(DAILY_CLEAN, QUALITY),
    "daily_lineage": _with(DAILY_CLEAN, LINEAGE),
    "daily_top_stations": _with(
        DAILY_CLEAN, TOTAL.format(key="station_complex_id") + " ORDER BY 2 DESC, 1 LIMIT 20"
    ),
    "daily_borough_totals": _with(DAILY_CLEAN, TOTAL.format(key="borough")),
    "daily_network_totals": _with(DAILY_CLEAN, DATE_TOTALS),
    "daily_split_counts": _with(DAILY_SPLIT, SPLIT_COUNTS),
    "daily_volatility": _with(DAILY_CLEAN, VOLATILITY.format(key="station_complex_id")),
}
