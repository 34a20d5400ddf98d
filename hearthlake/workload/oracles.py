"""The adapters and the star schema once more, as SQL common table expressions over the given tables."""

from __future__ import annotations

from hearthlake.schemas import READING_KEY

_EVENTS = """
ev_all AS (
  SELECT event_id AS id, date_trunc('minute', ts) AS ts,
         CASE WHEN user_id % 2 = 0 THEN 'apt_a' ELSE 'apt_b' END AS apartment,
         CASE user_id % 5 WHEN 0 THEN 'Bathroom' WHEN 1 THEN 'Bedroom' WHEN 2 THEN 'Living Room'
                          WHEN 3 THEN 'Office' ELSE 'Attic' END AS room,
         event_type, value AS v, user_id,
         'bronze/e' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS folder
  FROM events),
ev AS (SELECT * FROM ev_all WHERE NOT (event_type = 'click' AND id % 101 = 0)),
ord AS (
  SELECT o_orderkey AS id,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 25 YEAR + to_minutes(CAST(o_orderkey % 1440 AS INT)) AS ts,
         CASE WHEN o_custkey % 2 = 0 THEN 'apt_a' ELSE 'apt_b' END AS apartment, o_totalprice AS p,
         'bronze/o' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS folder
  FROM orders)"""


def _part(source: str, when: str, sensor_type: str, field: str, value: str, unit: str, room: str = "room") -> str:
    return (
        f"SELECT apartment, {room} AS room, '{sensor_type}' AS sensor_type, '{field}' AS field, "
        f"CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, ts AS \"timestamp\", folder FROM {source} WHERE {when}"
    )


_PARTS = [
    _part("ev", "event_type = 'click'", "plug", "power", "v * 30", "W"),
    _part("ev", "event_type = 'click'", "plug", "total", "v * 100", "Wh"),
    _part("ev", "event_type = 'purchase'", "plug", "power", "v", "W"),
    _part("ev", "event_type = 'purchase'", "plug", "total", "v * 10", "Wh"),
    _part("ev", "event_type = 'view'", "meteo", "temperature_c", "v", "C"),
    _part("ev", "event_type = 'view'", "meteo", "co2_ppm", "v * 20", "ppm"),
    _part("ev", "event_type = 'view'", "meteo", "humidity_pct", "v", "%"),
    _part("ev", "event_type = 'view'", "meteo", "noise_db", "v", "dB"),
    _part("ev", "event_type = 'view'", "meteo", "pressure_hpa", "v + 850", "hPa"),
    _part("ev", "event_type = 'view'", "meteo", "abs_pressure_hpa", "900", "hPa"),
    _part("ev", "event_type = 'view'", "meteo", "battery", "v", "%"),
    _part("ev", "event_type = 'signup'", "motion", "motion", "CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END", "bool"),
    _part("ev", "event_type = 'signup'", "motion", "light", "user_id", "lux"),
    _part("ev", "event_type = 'signup'", "motion", "temperature", "v", "C"),
    _part("ev", "event_type = 'error' AND id % 2 = 0", "door", "open", "CASE WHEN id % 5 < 2 THEN 1 ELSE 0 END", "bool"),
    _part("ev", "event_type = 'error' AND id % 2 = 0", "door", "battery", "v", "%"),
    _part("ev", "event_type = 'error' AND id % 2 = 0", "window", "open", "CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END", "bool"),
    _part("ev", "event_type = 'error' AND id % 2 = 1", "door", "open", "CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END", "bool"),
    _part("ev", "event_type = 'error'", "humidity", "temperature", "v / 2", "C"),
    _part("ev", "event_type = 'error'", "humidity", "humidity", "v", "%"),
    _part("ev", "event_type = 'error'", "humidity", "battery", "v", "%"),
    _part("ord", "true", "plug", "power", "p / 50", "W", "'Kitchen'"),
    _part("ord", "true", "plug", "total", "p", "Wh", "'Kitchen'"),
    _part("ord", "true", "consumption", "total_power", "p / 100", "W", "'House'"),
    _part("ord", "true", "consumption", "power1", "p / 300", "W", "'House'"),
    _part("ord", "true", "consumption", "current1", "p / 230", "A", "'House'"),
    _part("ord", "true", "consumption", "voltage1", "230", "V", "'House'"),
]

_READINGS = f"""
parts AS ({' UNION ALL '.join(_PARTS)}),
readings AS (
  SELECT *, coalesce(NOT CASE field
      WHEN 'temperature_c' THEN value BETWEEN -20 AND 60
      WHEN 'humidity_pct' THEN value BETWEEN 0 AND 100
      WHEN 'co2_ppm' THEN value BETWEEN 300 AND 5000
      WHEN 'noise_db' THEN value BETWEEN 0 AND 140
      WHEN 'pressure_hpa' THEN value BETWEEN 870 AND 1085
      WHEN 'power' THEN value BETWEEN 0 AND 10000
      WHEN 'battery' THEN value BETWEEN 0 AND 100
      ELSE true END, false) AS is_outlier
  FROM parts)"""

_FORECASTS = """
fc_raw AS (
  SELECT CASE WHEN l_linenumber = 7 AND l_quantity = 13 THEN NULL
              ELSE CAST(l_shipdate AS TIMESTAMP) + INTERVAL 25 YEAR + to_hours(CAST(l_orderkey % 24 AS INT)) END
           AS "timestamp",
         l_returnflag AS site, l_linenumber AS prediction,
         CAST(o_orderdate + INTERVAL 25 YEAR AS DATE) AS prediction_date,
         CASE l_partkey % 5 WHEN 0 THEN 'PRED_T_2M_ctrl' WHEN 1 THEN 'PRED_RELHUM_2M_ctrl'
              WHEN 2 THEN 'PRED_TOT_PREC_ctrl' WHEN 3 THEN 'PRED_GLOB_ctrl' ELSE 'PRED_OTHER' END AS measurement,
         CASE WHEN l_discount = 0 THEN NULL
              WHEN l_partkey % 5 = 0 THEN l_quantity * 2 - 30 WHEN l_partkey % 5 = 1 THEN l_quantity * 2.5
              WHEN l_partkey % 5 = 2 THEN l_quantity / 5 ELSE l_quantity * 35 END AS value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
forecasts AS (
  SELECT "timestamp", site, prediction, prediction_date, measurement, value, 'unit' AS unit,
         CASE measurement WHEN 'PRED_T_2M_ctrl' THEN NOT value BETWEEN -50 AND 60
              WHEN 'PRED_RELHUM_2M_ctrl' THEN NOT value BETWEEN 0 AND 100
              WHEN 'PRED_TOT_PREC_ctrl' THEN NOT value BETWEEN 0 AND 500
              ELSE NOT value BETWEEN 0 AND 1500 END AS is_outlier
  FROM fc_raw
  WHERE "timestamp" IS NOT NULL AND year("timestamp") >= 2023 AND measurement <> 'PRED_OTHER' AND value IS NOT NULL)"""

_DIMS = """
buildings AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id_building,
         CASE s_suppkey WHEN 3 THEN 'Villa ALPHA' WHEN 7 THEN 'Beta house' ELSE s_name END AS house_name
  FROM supplier),
members AS (SELECT DISTINCT apartment, room, sensor_type FROM readings),
owned AS (
  SELECT CASE WHEN lower(house_name) LIKE '%alpha%' THEN 'apt_a'
              WHEN lower(house_name) LIKE '%beta%' THEN 'apt_b' END AS apartment,
         min(CAST(id_building AS INT)) AS building_id
  FROM buildings GROUP BY 1),
dim_weather_site AS (
  SELECT row_number() OVER (ORDER BY substr(md5(site_name), 1, 3), site_name) AS site_key, site_name
  FROM (VALUES ('A'), ('N')) t(site_name)),
dim_apartment AS (
  SELECT row_number() OVER (ORDER BY substr(md5(m.apartment), 1, 3), m.apartment) AS apartment_key,
         m.apartment AS apartment_id, m.apartment AS name, building_id,
         CASE WHEN building_id IS NOT NULL THEN 'Building ' || building_id END AS building_name,
         (SELECT site_key FROM dim_weather_site WHERE site_name = 'A') AS weather_site_key
  FROM (SELECT DISTINCT apartment FROM members) m LEFT JOIN owned USING (apartment)),
dim_room AS (
  SELECT row_number() OVER (ORDER BY substr(md5(apartment_key || '|' || room_name), 1, 3), apartment_key, room_name)
           AS room_key, room_name, apartment_key
  FROM (SELECT DISTINCT room AS room_name, apartment_key FROM members JOIN dim_apartment ON apartment_id = apartment)),
dim_device AS (
  SELECT row_number() OVER (ORDER BY substr(md5(device_id || '|' || sensor_type), 1, 3), device_id, sensor_type)
           AS device_key, device_id, room_key, sensor_type
  FROM (SELECT apartment || '_' || room || '_' || sensor_type AS device_id, sensor_type, min(room_key) AS room_key
        FROM members JOIN dim_apartment a ON apartment_id = apartment
        JOIN dim_room r ON r.room_name = room AND r.apartment_key = a.apartment_key GROUP BY 1, 2)),
moments AS (SELECT "timestamp" AS d FROM readings UNION SELECT "timestamp" FROM forecasts),
dim_date AS (
  SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS date,
         dayname(d) AS day_of_week, CAST(week(d) AS INT) AS week, CAST(month(d) AS INT) AS month,
         CAST(year(d) AS INT) AS year, isodow(d) IN (6, 7) AS is_weekend, false AS is_holiday
  FROM moments),
dim_datetime AS (
  SELECT DISTINCT CAST(strftime(d, '%Y%m%d%H%M') AS BIGINT) AS datetime_key, date_trunc('minute', d) AS timestamp_utc,
         CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(hour(d) AS INT) AS hour, CAST(minute(d) AS INT) AS minute,
         dayname(d) AS day_of_week, CAST(week(d) AS INT) AS week, CAST(month(d) AS INT) AS month,
         CAST(year(d) AS INT) AS year, isodow(d) IN (6, 7) AS is_weekend, false AS is_holiday
  FROM moments),
dim_tariff AS (
  SELECT row_number() OVER (ORDER BY substr(md5(provider || '|' || year), 1, 3), provider, year) AS tariff_key,
         provider, year, chf_per_kwh
  FROM (VALUES ('OIKEN', 2023, 0.34), ('OIKEN', 2024, 0.34), ('OIKEN', 2025, 0.34)) t(provider, year, chf_per_kwh)),
keyed AS (
  SELECT s.*, CAST(strftime("timestamp", '%Y%m%d%H%M') AS BIGINT) AS datetime_key,
         CAST(strftime("timestamp", '%Y%m%d') AS INT) AS date_key, a.apartment_key, r.room_key, d.device_key
  FROM readings s JOIN dim_apartment a ON a.apartment_id = s.apartment
  JOIN dim_room r ON r.room_name = s.room AND r.apartment_key = a.apartment_key
  JOIN dim_device d ON d.device_id = s.apartment || '_' || s.room || '_' || s.sensor_type
       AND d.sensor_type = s.sensor_type)"""

_FACTS = """
fact_energy_minute AS (
  SELECT datetime_key, date_key, device_key, room_key, apartment_key,
         max(CASE WHEN field IN ('power', 'total_power') THEN value END) AS power_w,
         max(CASE WHEN field = 'total' THEN value / 1000.0 END) AS energy_kwh,
         bool_and(NOT is_outlier) AS is_valid
  FROM keyed WHERE sensor_type IN ('plug', 'consumption') GROUP BY 1, 2, 3, 4, 5),
fact_environment_minute AS (
  SELECT datetime_key, date_key, room_key, apartment_key,
         max(CASE WHEN field = 'temperature_c' OR (field = 'temperature' AND sensor_type IN ('meteo', 'humidity'))
                  THEN value END) AS temperature_c,
         max(CASE WHEN field = 'humidity_pct' OR (field = 'humidity' AND sensor_type IN ('meteo', 'humidity'))
                  THEN value END) AS humidity_pct,
         max(CASE WHEN field = 'co2_ppm' THEN value END) AS co2_ppm,
         max(CASE WHEN field = 'noise_db' THEN value END) AS noise_db,
         max(CASE WHEN field = 'pressure_hpa' THEN value END) AS pressure_hpa,
         bool_or(CASE WHEN sensor_type = 'window' AND field = 'open' THEN value = 1 END) AS window_open_flag,
         bool_or(CASE WHEN sensor_type = 'door' AND field = 'open' THEN value = 1 END) AS door_open_flag,
         bool_or(is_outlier) AS is_anomaly
  FROM keyed WHERE sensor_type IN ('meteo', 'humidity', 'door', 'window')
    AND field IN ('temperature_c', 'temperature', 'humidity_pct', 'humidity', 'co2_ppm', 'noise_db', 'pressure_hpa', 'open')
  GROUP BY 1, 2, 3, 4),
fact_presence_minute AS (
  SELECT datetime_key, date_key, room_key, apartment_key,
         CAST(sum(CASE WHEN sensor_type = 'motion' AND field = 'motion' AND value = 1 THEN 1 ELSE 0 END) AS INT)
           AS motion_count,
         bool_or(CASE WHEN sensor_type = 'door' AND field = 'open' THEN value = 1 END) AS door_open_flag,
         bool_or(sensor_type = 'motion' AND field = 'motion' AND value = 1) AS presence_flag,
         CAST(NULL AS DOUBLE) AS presence_prob
  FROM keyed WHERE sensor_type IN ('motion', 'door') AND field IN ('motion', 'open') GROUP BY 1, 2, 3, 4),
health_battery AS (
  SELECT date_key, device_key, room_key, apartment_key, min(value) AS battery_min_pct, avg(value) AS battery_avg_pct
  FROM keyed WHERE field = 'battery' GROUP BY 1, 2, 3, 4),
health_errors AS (
  SELECT CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key, device_key, count(*) AS error_count
  FROM ev_all JOIN dim_device ON device_id = apartment || '_' || room || '_humidity'
  WHERE event_type = 'error' GROUP BY 1, 2),
health_minutes AS (SELECT date_key, device_key, count(DISTINCT datetime_key) AS n FROM keyed GROUP BY 1, 2),
fact_device_health_day AS (
  SELECT date_key, device_key, room_key, apartment_key, CAST(coalesce(error_count, 0) AS INT) AS error_count,
         CAST(greatest(1440 - n, 0) AS INT) AS missing_readings,
         CAST(round(CAST(n * 100 AS DECIMAL(18, 6)) / 1440, 2) AS DOUBLE) AS uptime_pct,
         battery_min_pct, battery_avg_pct
  FROM health_battery LEFT JOIN health_errors USING (date_key, device_key)
  LEFT JOIN health_minutes USING (date_key, device_key)),
fact_weather_hour AS (
  SELECT CAST(strftime("timestamp", '%Y%m%d%H%M') AS BIGINT) AS datetime_key,
         CAST(strftime("timestamp", '%Y%m%d') AS INT) AS date_key, site_key, prediction_date,
         avg(CASE WHEN measurement = 'PRED_T_2M_ctrl' THEN value END) AS temperature_c,
         avg(CASE WHEN measurement = 'PRED_RELHUM_2M_ctrl' THEN value END) AS humidity_pct,
         avg(CASE WHEN measurement = 'PRED_TOT_PREC_ctrl' THEN value END) AS precipitation_mm,
         avg(CASE WHEN measurement = 'PRED_GLOB_ctrl' THEN value END) AS radiation_wm2,
         CAST(count(DISTINCT prediction) AS INT) AS n_model_runs
  FROM forecasts JOIN dim_weather_site ON site_name = site WHERE NOT is_outlier GROUP BY 1, 2, 3, 4),
mv_energy_with_cost AS (
  SELECT f.*, t.chf_per_kwh,
         round(CAST(energy_kwh * CAST(t.chf_per_kwh AS DOUBLE) AS DECIMAL(38, 15)), 4) AS cost_chf
  FROM fact_energy_minute f JOIN dim_date d ON d.date_key = f.date_key
  LEFT JOIN dim_tariff t ON t.year = d.year AND t.provider = 'OIKEN')"""

_KEY = ", ".join(f'"{k}"' for k in READING_KEY)
LAST_READINGS = f"""
last_readings AS (
  SELECT * EXCLUDE (pos) FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY}
      ORDER BY "timestamp" DESC, folder DESC, value DESC, unit DESC) AS pos FROM readings) WHERE pos = 1)"""

READING_CTES = ["WITH" + _EVENTS, _READINGS]
FORECAST_CTES = [_FORECASTS]


def over_readings(select: str, *more: str) -> str:
    return ",".join([*READING_CTES, *more]) + "\n" + select


def over_forecasts(select: str) -> str:
    return "WITH" + _FORECASTS + "\n" + select


def over_star(select: str, *more: str, merged: bool = False) -> str:
    """The star schema over all readings, or over the last reading per key."""
    silver = READING_CTES
    if merged:
        every = [cte.replace("readings AS (", "every_reading AS (") for cte in READING_CTES]
        last = LAST_READINGS.replace("FROM readings)", "FROM every_reading)").replace("last_readings AS", "readings AS")
        silver = [*every, last]
    return ",".join([*silver, _FORECASTS, _DIMS, _FACTS, *more]) + "\n" + select
