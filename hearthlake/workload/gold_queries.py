"""Queries over dimensions, facts, measures, reports, privacy and ML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import schemas, session
from hearthlake.operators import freshness, privacy, quality
from hearthlake.plans import dimensions, facts, measures, ml, reports
from hearthlake.workload import adapters, oracles
from hearthlake.workload.registry import query, rounded, rounded_sql

_CALENDAR = "day_of_week, week, month, year, is_weekend, is_holiday"

# ---- dimensions -------------------------------------------------------------------------------------------------


_HASHED = "CAST('0x' || substr(sha256(length({0}) || ':' || {0}{1}), 1, 15) AS BIGINT)"


@query(
    "SELECT 'customer' AS member_of, CAST(c_custkey AS VARCHAR) AS member, "
    + _HASHED.format("CAST(c_custkey AS VARCHAR)", " || length(c_name) || ':' || c_name")
    + " AS member_key FROM customer UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), "
    + _HASHED.format("CAST(o_orderkey AS VARCHAR)", "")
    + " FROM (SELECT DISTINCT o_orderkey FROM orders)"
)
def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of members too many to number densely; the load aborts if two members have one key."""
    from hearthlake.operators import surrogate

    out = []
    for name, natural in (("customer", ["c_custkey", "c_name"]), ("orders", ["o_orderkey"])):
        members = adapters.table(spark, sf_dir, name).select(*natural)
        keyed = surrogate.with_hash_keys(members, natural, "member_key")
        out.append(keyed.select(F.lit(name).alias("member_of"), F.col(natural[0]).cast("string").alias("member"), "member_key"))
    return out[0].unionByName(out[1])


@query(oracles.over_star(f"SELECT date_key, date, {_CALENDAR} FROM dim_date"))
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_date(adapters.readings(spark, sf_dir), adapters.forecasts(spark, sf_dir))


@query(oracles.over_star(f"SELECT datetime_key, timestamp_utc, date_key, hour, minute, {_CALENDAR} FROM dim_datetime"))
def dim_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_datetime(adapters.readings(spark, sf_dir), adapters.forecasts(spark, sf_dir))


@query(
    oracles.over_star(
        """SELECT apartment_key, apartment_id, name, building_id, building_name, owner_user_id, weather_site_key
           FROM (SELECT *, CAST(NULL AS VARCHAR) AS owner_user_id FROM dim_apartment)"""
    )
)
def dim_apartment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apartments enriched from the registry, masked, and linked to the first weather site."""
    apartments = adapters.dims(spark, sf_dir)["dim_apartment"]
    linked = dimensions.link_weather_site(apartments, adapters.sites(spark), adapters.SITES[0])
    return linked.select(
        "apartment_key", "apartment_id", "name", "building_id", "building_name", "owner_user_id", "weather_site_key"
    )


@query(oracles.over_star("SELECT room_key, room_name, apartment_key FROM dim_room"))
def dim_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.dims(spark, sf_dir)["dim_room"].select("room_key", "room_name", "apartment_key")


@query(oracles.over_star("SELECT device_key, device_id, room_key, sensor_type, true AS is_active FROM dim_device"))
def dim_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = adapters.dims(spark, sf_dir)["dim_device"]
    return devices.select("device_key", "device_id", "room_key", "sensor_type", "is_active")


@query(
    """SELECT row_number() OVER (ORDER BY substr(md5(provider || '|' || year), 1, 3), provider, year) AS tariff_key,
         provider, year, chf_per_kwh
       FROM (SELECT 'OIKEN' AS provider, year, CAST(CASE WHEN year = 2024 THEN 0.36 ELSE 0.34 END AS DOUBLE) AS chf_per_kwh
             FROM (SELECT DISTINCT CAST(year(o_orderdate) + 25 AS INT) AS year FROM orders))"""
)
def dim_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices for the years found in the orders, one of them changed by a second load."""
    years = adapters.table(spark, sf_dir, "orders").select((F.year("o_orderdate") + 25).alias("year")).distinct()
    given = years.select(F.lit("OIKEN").alias("provider"), "year", F.lit("0.34").alias("price"))
    first = session.materialise(dimensions.dim_tariff(spark, given), "dim_tariff")
    return rounded(dimensions.dim_tariff(spark, [("OIKEN", 2024, "0.36")], existing=first))


@query(
    """SELECT row_number() OVER (ORDER BY substr(md5(site_name), 1, 3), site_name) AS site_key, site_name
       FROM (SELECT DISTINCT l_returnflag AS site_name FROM lineitem)"""
)
def dim_weather_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("site_name"))
    return dimensions.dim_weather_site(sites)


@query(
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey)
                    AS k FROM customer WHERE c_nationkey < 10),
            b AS (SELECT c_custkey, (SELECT count(*) FROM a)
                    + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) AS k
                  FROM customer WHERE c_nationkey >= 10)
       SELECT c_custkey AS member, k AS member_key FROM a UNION ALL SELECT c_custkey, k FROM b"""
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys given to a first set of members stay when more members arrive."""
    from hearthlake.operators import surrogate

    member = F.col("c_custkey").alias("member")
    customers = adapters.table(spark, sf_dir, "customer")
    first = surrogate.extend(customers.filter("c_nationkey < 10").select(member), None, ["member"], "member_key")
    return surrogate.extend(customers.select(member), first, ["member"], "member_key").select("member", "member_key")


# ---- facts ------------------------------------------------------------------------------------------------------


@query(
    oracles.over_star(
        f"""SELECT datetime_key, date_key, device_key, room_key, apartment_key, {rounded_sql("power_w", "energy_kwh")},
            is_valid FROM fact_energy_minute"""
    )
)
def fact_energy_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = adapters.readings(spark, sf_dir)
    return rounded(facts.fact_energy_minute(silver, adapters.stored_dims(spark, sf_dir)))


_ENVIRONMENT = ["temperature_c", "humidity_pct", "co2_ppm", "noise_db", "pressure_hpa"]


@query(
    oracles.over_star(
        f"""SELECT datetime_key, date_key, room_key, apartment_key, {rounded_sql(*_ENVIRONMENT)}, window_open_flag,
            door_open_flag, is_anomaly FROM fact_environment_minute"""
    )
)
def fact_environment_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = adapters.readings(spark, sf_dir)
    return rounded(facts.fact_environment_minute(silver, adapters.stored_dims(spark, sf_dir)))


@query(oracles.over_star("SELECT * FROM fact_presence_minute"))
def fact_presence_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = adapters.readings(spark, sf_dir)
    return facts.fact_presence_minute(silver, adapters.stored_dims(spark, sf_dir))


@query(
    oracles.over_star(
        f"""SELECT date_key, device_key, room_key, apartment_key, error_count, missing_readings,
            {rounded_sql("uptime_pct", "battery_min_pct", "battery_avg_pct")} FROM fact_device_health_day"""
    )
)
def fact_device_health_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = adapters.readings(spark, sf_dir)
    errors = adapters.device_errors(spark, sf_dir)
    return rounded(facts.fact_device_health_day(silver, errors, adapters.stored_dims(spark, sf_dir)))


_WEATHER = ["temperature_c", "humidity_pct", "precipitation_mm", "radiation_wm2"]


@query(
    oracles.over_star(
        f"""SELECT datetime_key, date_key, site_key, prediction_date, {rounded_sql(*_WEATHER)}, n_model_runs
            FROM fact_weather_hour"""
    )
)
def fact_weather_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(facts.fact_weather_hour(adapters.forecasts(spark, sf_dir), adapters.sites(spark)))


@query(
    oracles.over_star(
        f"""SELECT datetime_key, date_key, device_key, {rounded_sql("energy_kwh", "chf_per_kwh", "cost_chf")}
            FROM mv_energy_with_cost"""
    )
)
def energy_with_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    costed = adapters.star(spark, sf_dir, "mv_energy_with_cost")["mv_energy_with_cost"]
    return rounded(costed.select("datetime_key", "date_key", "device_key", "energy_kwh", "chf_per_kwh", "cost_chf"))


_SLOTS = """
power_slots AS (
  SELECT apartment_key, room_key, time_bucket(INTERVAL 15 MINUTE, timestamp_utc) AS slot, avg(p) AS power_w
  FROM (SELECT apartment_key, room_key, datetime_key, sum(power_w) AS p FROM fact_energy_minute GROUP BY 1, 2, 3)
  JOIN dim_datetime USING (datetime_key) GROUP BY 1, 2, 3),
presence_slots AS (
  SELECT apartment_key, room_key, time_bucket(INTERVAL 15 MINUTE, timestamp_utc) AS slot,
         CAST(max(CAST(presence_flag AS INT)) AS INT) AS occupied, CAST(sum(motion_count) AS BIGINT) AS motion_count
  FROM fact_presence_minute JOIN dim_datetime USING (datetime_key) GROUP BY 1, 2, 3),
slots AS (
  SELECT apartment_key, room_key, slot, apartment_id AS apartment, room_name AS room, power_w, occupied, motion_count
  FROM power_slots FULL JOIN presence_slots USING (apartment_key, room_key, slot)
  JOIN dim_apartment USING (apartment_key) JOIN dim_room USING (apartment_key, room_key))"""


def _slots(star: dict[str, DataFrame]) -> DataFrame:
    return facts.room_slots(star["fact_energy_minute"], star["fact_presence_minute"], star)


@query(
    oracles.over_star(
        f"SELECT apartment, room, slot, {rounded_sql('power_w')}, occupied, motion_count FROM slots", _SLOTS
    )
)
def room_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power and occupancy per room and quarter of an hour."""
    slots = _slots(adapters.star(spark, sf_dir, "fact_energy_minute", "fact_presence_minute"))
    return rounded(slots.drop("apartment_key", "room_key"))


_TABLES = ["dim_apartment", "dim_room", "dim_device", "dim_date", "dim_datetime", "dim_tariff", "dim_weather_site"]
_FACT_TABLES = [
    "fact_environment_minute", "fact_energy_minute", "fact_presence_minute", "fact_device_health_day", "fact_weather_hour"
]
# What is left of each parent, by attributes that both engines know.
_CUT = {
    "dim_apartment": "apartment_id = 'apt_b'",
    "dim_room": "length(room_name) > 5",
    "dim_device": "sensor_type = 'plug'",
    "dim_date": "day_of_week <> 'Monday'",
    "dim_datetime": "minute % 2 = 0",
    "dim_weather_site": "site_name = 'A'",
}
_REFERENCES = [
    (child, column, parent, key) for child, keys in schemas.FOREIGN_KEYS.items() for column, parent, key in keys
]


@query(
    oracles.over_star(
        " UNION ALL ".join(
            f"""SELECT '{child}' AS table_name, '{column}' AS column_name, count(*) AS orphan_rows FROM {child} AS c
                WHERE {_CUT.get(child, "TRUE")} AND c.{column} IS NOT NULL
                AND c.{column} NOT IN (SELECT {key} FROM {parent} WHERE {_CUT[parent]})"""
            for child, column, parent, key in _REFERENCES
        )
    )
)
def orphan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dangling references of every foreign key, after members were removed from every parent."""
    star = adapters.star(spark, sf_dir, *_FACT_TABLES)
    return quality.orphan_report(star | {name: star[name].filter(left) for name, left in _CUT.items()})


# ---- measures ---------------------------------------------------------------------------------------------------

_LOCATED = "JOIN dim_apartment USING (apartment_key) JOIN dim_date USING (date_key)"


@query(
    oracles.over_star(
        f"""SELECT apartment_id, year, {rounded_sql("total_energy_kwh", "avg_power_w", "peak_power_w")} FROM (
              SELECT apartment_id, year, sum(energy_kwh) AS total_energy_kwh, avg(power_w) AS avg_power_w,
                     max(power_w) AS peak_power_w FROM fact_energy_minute {_LOCATED} GROUP BY 1, 2)"""
    )
)
def energy_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_energy_minute")
    names = ["total_energy_kwh", "avg_power_w", "peak_power_w"]
    return rounded(measures.aggregate(names, star, ["apartment_id", "year"]))


@query(
    oracles.over_star(
        f"""SELECT year, {rounded_sql("total_cost_chf")} FROM (
              SELECT year, sum(cost_chf) AS total_cost_chf FROM mv_energy_with_cost JOIN dim_date USING (date_key)
              GROUP BY 1)"""
    )
)
def total_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per year; years without a price have none."""
    return rounded(measures.measure("total_cost_chf", adapters.star(spark, sf_dir, "mv_energy_with_cost"), ["year"]))


@query(
    oracles.over_star(
        f"""SELECT year, month, {rounded_sql("daily_cost_chf")} FROM (
              SELECT year, month, CAST(sum(cost_chf) AS DOUBLE) / any_value(days) AS daily_cost_chf
              FROM mv_energy_with_cost JOIN dim_date USING (date_key)
              JOIN (SELECT year, month, count(DISTINCT date) AS days FROM dim_date GROUP BY 1, 2) USING (year, month)
              GROUP BY 1, 2)"""
    )
)
def daily_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per calendar day of the month."""
    star = adapters.star(spark, sf_dir, "mv_energy_with_cost")
    return rounded(measures.measure("daily_cost_chf", star, ["year", "month"]))


@query(
    oracles.over_star(
        f"""SELECT apartment_id, day_of_week, {rounded_sql("avg_indoor_temp_c", "avg_indoor_humidity_pct", "avg_co2_ppm",
            "anomaly_rate_pct")} FROM (
              SELECT apartment_id, day_of_week, avg(temperature_c) AS avg_indoor_temp_c,
                     avg(humidity_pct) AS avg_indoor_humidity_pct, avg(co2_ppm) AS avg_co2_ppm,
                     count(*) FILTER (WHERE is_anomaly) * 100.0 / count(*) AS anomaly_rate_pct
              FROM fact_environment_minute {_LOCATED} GROUP BY 1, 2)"""
    )
)
def environment_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_environment_minute")
    names = ["avg_indoor_temp_c", "avg_indoor_humidity_pct", "avg_co2_ppm", "anomaly_rate_pct"]
    return rounded(measures.aggregate(names, star, ["apartment_id", "day_of_week"]))


@query(
    oracles.over_star(
        f"""SELECT room_name, {rounded_sql("occupancy_rate_pct")}, total_motion_events FROM (
              SELECT room_name, count(*) FILTER (WHERE presence_flag) * 100.0 / count(*) AS occupancy_rate_pct,
                     sum(motion_count) AS total_motion_events
              FROM fact_presence_minute JOIN dim_room USING (room_key) GROUP BY 1)"""
    )
)
def presence_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_presence_minute")
    return rounded(measures.aggregate(["occupancy_rate_pct", "total_motion_events"], star, ["room_name"]))


_OUTDOOR = ["avg_outdoor_temp_c", "avg_outdoor_humidity_pct", "total_precipitation_mm", "avg_radiation_wm2"]


@query(
    oracles.over_star(
        f"""SELECT site_name, year, {rounded_sql(*_OUTDOOR)} FROM (
              SELECT site_name, year, avg(temperature_c) AS avg_outdoor_temp_c, avg(humidity_pct) AS avg_outdoor_humidity_pct,
                     sum(precipitation_mm) AS total_precipitation_mm, avg(radiation_wm2) AS avg_radiation_wm2
              FROM fact_weather_hour JOIN dim_weather_site USING (site_key) JOIN dim_date USING (date_key) GROUP BY 1, 2)"""
    )
)
def outdoor_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_weather_hour")
    return rounded(measures.aggregate(_OUTDOOR, star, ["site_name", "year"]))


@query(
    oracles.over_star(
        f"""SELECT date, {rounded_sql("temp_delta_c")} FROM (
              SELECT date, i - o AS temp_delta_c FROM (
                SELECT date, avg(temperature_c) AS i FROM fact_environment_minute JOIN dim_date USING (date_key) GROUP BY 1)
              FULL JOIN (SELECT date, avg(temperature_c) AS o FROM fact_weather_hour JOIN dim_date USING (date_key)
                         GROUP BY 1) USING (date))"""
    )
)
def temperature_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indoor minus outdoor mean temperature per day."""
    star = adapters.star(spark, sf_dir, "fact_environment_minute", "fact_weather_hour")
    return rounded(measures.measure("temp_delta_c", star, ["date"]))


@query(
    oracles.over_star(
        f"""SELECT sensor_type, {rounded_sql("avg_uptime_pct", "avg_battery_pct")}, total_missing_readings FROM (
              SELECT sensor_type, avg(uptime_pct) AS avg_uptime_pct, sum(missing_readings) AS total_missing_readings,
                     avg(battery_avg_pct) AS avg_battery_pct
              FROM fact_device_health_day JOIN dim_device USING (device_key) GROUP BY 1)"""
    )
)
def device_health_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_device_health_day")
    names = ["avg_uptime_pct", "total_missing_readings", "avg_battery_pct"]
    return rounded(measures.aggregate(names, star, ["sensor_type"]))


@query(
    oracles.over_star(
        f"""SELECT year, month, week, date, level, {rounded_sql("total_energy_kwh")} FROM (
              SELECT year, month, week, date, bit_count(grouping(year, month, week, date)) AS level,
                     sum(energy_kwh) AS total_energy_kwh
              FROM fact_energy_minute JOIN dim_date USING (date_key) GROUP BY ROLLUP (year, month, week, date))"""
    )
)
def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy at every level of Year > Month > Week > Day."""
    return rounded(measures.drill_down("total_energy_kwh", adapters.star(spark, sf_dir, "fact_energy_minute")))


# ---- report pages -----------------------------------------------------------------------------------------------


@query(
    oracles.over_star(
        f"""SELECT apartment_id, room_name, {rounded_sql("total_energy_kwh", "avg_power_w", "peak_power_w")} FROM (
              SELECT apartment_id, room_name, sum(energy_kwh) AS total_energy_kwh, avg(power_w) AS avg_power_w,
                     max(power_w) AS peak_power_w
              FROM fact_energy_minute f JOIN dim_apartment a USING (apartment_key) JOIN dim_room r USING (room_key)
              GROUP BY 1, 2)"""
    )
)
def energy_by_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.energy_by_room(adapters.star(spark, sf_dir, "fact_energy_minute")))


@query(
    oracles.over_star(
        f"""SELECT date, {rounded_sql("total_energy_kwh")} FROM (SELECT date, sum(energy_kwh) AS total_energy_kwh
            FROM fact_energy_minute JOIN dim_date USING (date_key) GROUP BY 1)"""
    )
)
def energy_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.energy_trend(adapters.star(spark, sf_dir, "fact_energy_minute")))


@query(
    oracles.over_star(
        f"""SELECT apartment_id, year, month, {rounded_sql("total_cost_chf")} FROM (
              SELECT apartment_id, year, month, sum(cost_chf) AS total_cost_chf FROM mv_energy_with_cost {_LOCATED}
              GROUP BY 1, 2, 3)"""
    )
)
def cost_by_apartment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.cost_by_apartment(adapters.star(spark, sf_dir, "mv_energy_with_cost")))


_ROOM_MEANS = ["avg_indoor_temp_c", "avg_indoor_humidity_pct", "avg_co2_ppm", "avg_noise_db", "avg_pressure_hpa"]


@query(
    oracles.over_star(
        f"""SELECT apartment_id, room_name, {rounded_sql(*_ROOM_MEANS)}, outlier_minutes, environment_minutes FROM (
              SELECT apartment_id, room_name, avg(temperature_c) AS avg_indoor_temp_c, avg(humidity_pct) AS avg_indoor_humidity_pct,
                     avg(co2_ppm) AS avg_co2_ppm, avg(noise_db) AS avg_noise_db, avg(pressure_hpa) AS avg_pressure_hpa,
                     count(*) FILTER (WHERE is_anomaly) AS outlier_minutes, count(*) AS environment_minutes
              FROM fact_environment_minute JOIN dim_apartment USING (apartment_key) JOIN dim_room USING (room_key)
              GROUP BY 1, 2)"""
    )
)
def room_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.room_comparison(adapters.star(spark, sf_dir, "fact_environment_minute")))


_PRESENCE_RATES = """round(CAST(count(*) FILTER (WHERE presence_flag) * 100.0 / count(*) AS DOUBLE), 6)
                     AS occupancy_rate_pct"""


@query(
    oracles.over_star(
        f"""SELECT day_of_week, hour, {_PRESENCE_RATES}, sum(motion_count) AS total_motion_events
            FROM fact_presence_minute JOIN dim_datetime USING (datetime_key) GROUP BY 1, 2"""
    )
)
def presence_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.presence_heatmap(adapters.star(spark, sf_dir, "fact_presence_minute")))


@query(
    oracles.over_star(
        f"""SELECT apartment_id, hour, {_PRESENCE_RATES} FROM fact_presence_minute
            JOIN dim_datetime USING (datetime_key) JOIN dim_apartment USING (apartment_key) GROUP BY 1, 2"""
    )
)
def occupancy_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.occupancy_pattern(adapters.star(spark, sf_dir, "fact_presence_minute")))


# ---- privacy ----------------------------------------------------------------------------------------------------


@query(
    oracles.over_star(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
            for name, source in {
                "dim_apartment": "dim_apartment WHERE apartment_id = 'apt_b'",
                "dim_room": "dim_room JOIN dim_apartment USING (apartment_key) WHERE apartment_id = 'apt_b'",
                "dim_device": "dim_device WHERE device_id LIKE 'apt_b%'",
                "dim_weather_site": "dim_weather_site",
                "fact_presence_minute": "fact_presence_minute JOIN dim_apartment USING (apartment_key) "
                "WHERE apartment_id = 'apt_b'",
            }.items()
        )
    )
)
def row_level_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table that the tenant of one apartment may see."""
    star = adapters.star(spark, sf_dir, "fact_presence_minute")
    role = F.concat(F.lit("tenant "), "apartment_id").alias("role")
    grants = star["dim_apartment"].select(role, "apartment_key")
    names = ["dim_apartment", "dim_room", "dim_device", "dim_weather_site", "fact_presence_minute"]
    seen = privacy.visible({n: star[n] for n in names}, grants, "tenant apt_b")
    return quality.row_counts(seen)


@query(
    oracles.over_readings(
        """SELECT room, sensor_type, field, round(value, 6) AS value, unit, "timestamp" FROM readings
           WHERE apartment = 'apt_a'"""
    )
)
def subject_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of one apartment."""
    own = privacy.subject_access(adapters.readings(spark, sf_dir), "apt_a")
    return rounded(own.select("room", "sensor_type", "field", "value", "unit", "timestamp"))


@query(
    oracles.over_star(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
            for name, source in {
                "dim_apartment": "dim_apartment WHERE apartment_id <> 'apt_a'",
                "dim_room": "dim_room JOIN dim_apartment USING (apartment_key) WHERE apartment_id <> 'apt_a'",
                "dim_device": "dim_device WHERE device_id NOT LIKE 'apt_a%'",
                "dim_weather_site": "dim_weather_site",
                "fact_energy_minute": "fact_energy_minute JOIN dim_apartment USING (apartment_key) "
                "WHERE apartment_id <> 'apt_a'",
                "sensor_events": "readings WHERE apartment <> 'apt_a'",
            }.items()
        )
    )
)
def erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after one apartment was erased from silver and gold."""
    star = adapters.star(spark, sf_dir, "fact_energy_minute")
    names = ["dim_apartment", "dim_room", "dim_device", "dim_weather_site", "fact_energy_minute"]
    everything = {n: star[n] for n in names} | {"sensor_events": adapters.readings(spark, sf_dir)}
    leaving = spark.createDataFrame([("apt_a",)], "apartment string")
    return quality.row_counts(privacy.erase(everything, leaving))


# ---- ML ---------------------------------------------------------------------------------------------------------

_LAGS = {"15m": 900, "1h": 3600, "24h": 86400}


def _range(column: str, seconds: int) -> str:
    side = "PRECEDING" if seconds < 0 else "FOLLOWING"
    at = f"{abs(seconds)} {side}"
    return (
        f"max({column}) OVER (PARTITION BY apartment_key, room_key ORDER BY epoch(slot) "
        f"RANGE BETWEEN {at} AND {at})"
    )


_FEATURES = f"""
known AS (
  SELECT site_key, datetime_key, arg_max(struct_pack(t := temperature_c, h := humidity_pct, p := precipitation_mm,
         r := radiation_wm2), prediction_date) AS newest
  FROM fact_weather_hour WHERE CAST(strftime(prediction_date, '%Y%m%d') AS INT) <= date_key GROUP BY 1, 2),
hourly AS (
  SELECT site_key, datetime_key // 100 AS hour_key, avg(newest.t) AS outdoor_temperature_c,
         avg(newest.h) AS outdoor_humidity_pct, avg(newest.p) AS outdoor_precipitation_mm,
         avg(newest.r) AS outdoor_radiation_wm2 FROM known GROUP BY 1, 2),
features AS (
  SELECT s.apartment, s.room, s.slot, power_w, occupied, motion_count,
         {', '.join(f"{_range('power_w', -s)} AS power_w_lag_{n}" for n, s in _LAGS.items())},
         {', '.join(f"{_range('occupied', -s)} AS occupied_lag_{n}" for n, s in _LAGS.items())},
         {_range('occupied', 3600)} AS label_occupied, {_range('power_w', 86400)} AS label_power_w,
         hour(slot) AS hour, isodow(slot) - 1 AS day_of_week, CASE WHEN isodow(slot) >= 6 THEN 1 ELSE 0 END AS weekend,
         outdoor_temperature_c, outdoor_humidity_pct, outdoor_precipitation_mm, outdoor_radiation_wm2
  FROM slots s LEFT JOIN hourly ON site_key = (SELECT site_key FROM dim_weather_site WHERE site_name = 'A')
       AND hour_key = CAST(strftime(slot, '%Y%m%d%H') AS BIGINT))"""

_FEATURE_DOUBLES = ["power_w", *[f"power_w_lag_{n}" for n in _LAGS], "label_power_w", *[f"outdoor_{c}" for c in _WEATHER]]
_FEATURE_INTS = ["occupied", "motion_count", *[f"occupied_lag_{n}" for n in _LAGS], "label_occupied", "hour", "day_of_week", "weekend"]


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = adapters.star(spark, sf_dir, "fact_energy_minute", "fact_presence_minute", "fact_weather_hour")
    return ml.features(_slots(star), star["fact_weather_hour"], star["dim_apartment"])


@query(
    oracles.over_star(
        f"SELECT apartment, room, slot, {rounded_sql(*_FEATURE_DOUBLES)}, {', '.join(_FEATURE_INTS)} FROM features",
        _SLOTS,
        _FEATURES,
    )
)
def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs and labels per room and slot."""
    return rounded(_features(spark, sf_dir).drop("apartment_key", "room_key"))


_TARGETS = {
    "occupancy": ("logistic_regression", "Presence", "HOUR", "label_occupied", "actual_occupied"),
    "consumption": ("linear_regression", "Consumption", "DAY", "label_power_w", "actual_power_w"),
}
_CUT_AT = "(SELECT to_timestamp(floor((min(epoch(slot)) * 0.25 + max(epoch(slot)) * 0.75) / 900) * 900)::TIMESTAMP FROM features)"


def _predicted(kind: str) -> str:
    """The predictions that the model has to make, with what came true."""
    model, target, unit, label, actual = _TARGETS[kind]
    return f"""predicted AS (
      SELECT apartment, room, slot + INTERVAL 1 {unit} AS timestamp_rounded, '{model}' AS model_name, '{target}' AS target,
             TIMESTAMP '{adapters.NOW}' AS prediction_made_at, {label} AS {actual} FROM features WHERE slot >= {_CUT_AT})"""


def _predictions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Fit on the first three quarters of the time, predict the slots of the last, store and read them back."""
    rows = session.materialise(_features(spark, sf_dir), "features")
    cut = ml.split_time(rows, 0.75)
    made_at = F.lit(adapters.NOW).cast("timestamp")
    fit, predict, ahead = {
        "occupancy": (ml.fit_occupancy, ml.predict_occupancy, ml.HOUR),
        "consumption": (ml.fit_consumption, ml.predict_consumption, ml.DAY),
    }[kind]
    path = session.new_path(spark, f"fact_prediction_{kind}")
    model = fit(ml.known_before(rows, cut, ahead))
    ml.store_predictions(predict(model, rows.filter(F.col("slot") >= cut), made_at), path, "year")
    return spark.read.parquet(path).drop("period")


_KEYS = "apartment, room, timestamp_rounded, model_name, target, prediction_made_at"


@query(oracles.over_star(f"SELECT {_KEYS}, actual_occupied, TRUE AS is_probability FROM predicted", _SLOTS, _FEATURES, _predicted("occupancy")))
def occupancy_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction of the held-out slots with its outcome; the predicted value must be a probability."""
    found = _predictions(spark, sf_dir, "occupancy")
    return found.withColumn("is_probability", F.col("predicted_occupied").between(0, 1)).drop("predicted_occupied")


@query(
    oracles.over_star(
        f"SELECT {_KEYS}, {rounded_sql('actual_power_w')}, TRUE AS is_number FROM predicted", _SLOTS, _FEATURES, _predicted("consumption")
    )
)
def consumption_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction of the held-out slots with its outcome; the predicted value must be a finite number."""
    found = _predictions(spark, sf_dir, "consumption")
    number = F.coalesce(F.abs("predicted_power_w") < float("inf"), F.lit(False))
    return rounded(found.withColumn("is_number", number).drop("predicted_power_w"))


@query(
    oracles.over_star(
        f"""SELECT model_name, target, slots, {rounded_sql("mean_actual")}, TRUE AS consistent FROM (
              SELECT model_name, target, count(*) AS slots, avg(actual_power_w) AS mean_actual FROM predicted
              WHERE actual_power_w IS NOT NULL GROUP BY 1, 2)""",
        _SLOTS,
        _FEATURES,
        _predicted("consumption"),
    )
)
def prediction_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out slots of the consumption model; its errors must agree with each other (|bias| <= mae <= rmse)."""
    errors = ml.backtest(_predictions(spark, sf_dir, "consumption"), "predicted_power_w", "actual_power_w")
    consistent = (F.abs("bias") <= F.col("mae") + 1e-9) & (F.col("mae") <= F.col("rmse") + 1e-9)
    return rounded(errors.select("model_name", "target", "slots", "mean_actual", consistent.alias("consistent")))


@query(
    oracles.over_star(
        f"""SELECT model_name, apartment, room, CAST(timestamp_rounded AS DATE) AS date,
              round(avg(actual_power_w), 6) AS avg_actual, count(actual_power_w) AS slots_with_actual, TRUE AS has_prediction
            FROM predicted GROUP BY 1, 2, 3, 4""",
        _SLOTS,
        _FEATURES,
        _predicted("consumption"),
    )
)
def predicted_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted and observed consumption side by side."""
    predictions = _predictions(spark, sf_dir, "consumption")
    page = reports.predicted_vs_actual(predictions, "predicted_power_w", "actual_power_w")
    return rounded(page.withColumn("has_prediction", F.col("avg_predicted").isNotNull()).drop("avg_predicted"))


_SHARES = [0.5, 0.625, 0.75, 0.875]
_HORIZON_DAYS = 180
_FOLDS = f"""
cuts AS (
  SELECT fold, floor((min(epoch(slot)) * (1 - share) + max(epoch(slot)) * share) / 900) * 900 AS cut
  FROM features, (VALUES {", ".join(f"({n}, CAST({s} AS DOUBLE))" for n, s in enumerate(_SHARES))}) shares(fold, share)
  GROUP BY fold, share),
folds AS (SELECT fold, cut, lead(cut) OVER (ORDER BY fold) AS until FROM cuts)"""


@query(
    oracles.over_star(
        f"""SELECT 'linear_regression' AS model_name, 'Consumption' AS target, fold, CAST(to_timestamp(cut) AS TIMESTAMP) AS cut,
              CAST(floor((epoch(slot) - cut) / ({_HORIZON_DAYS} * 86400)) AS INT) AS horizon, count(*) AS slots,
              round(avg(label_power_w), 6) AS mean_actual, TRUE AS consistent
            FROM features JOIN folds ON epoch(slot) >= cut AND (until IS NULL OR epoch(slot) < until)
            WHERE label_power_w IS NOT NULL GROUP BY ALL""",
        _SLOTS,
        _FEATURES,
        _FOLDS,
    )
)
def rolling_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumption models fitted at four cuts, their held-out slots and outcomes per fold and half year after the cut."""
    rows = session.materialise(_features(spark, sf_dir), "features")
    errors = ml.rolling_backtest(rows, ml.CONSUMPTION, _SHARES, _HORIZON_DAYS)
    consistent = (F.abs("bias") <= F.col("mae") + 1e-9) & (F.col("mae") <= F.col("rmse") + 1e-9)
    return rounded(errors.drop("mae", "rmse", "bias").join(errors.select("fold", "horizon", consistent.alias("consistent")), ["fold", "horizon"]))


# ---- reports over stored predictions too ------------------------------------------------------------------------

_PREDICTION_TABLES = {"fact_prediction_motion": "occupancy", "fact_prediction_consumption": "consumption"}
_HELD_OUT = f"held_out AS (SELECT slot FROM features WHERE slot >= {_CUT_AT})"


@query(
    oracles.over_star(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows, CASE WHEN count(*) > 0 THEN 'ready' ELSE 'empty' END AS status "
            f"FROM {table}"
            for name, table in [(t, t) for t in _TABLES + _FACT_TABLES] + [(t, "held_out") for t in _PREDICTION_TABLES]
        ),
        _SLOTS,
        _FEATURES,
        _HELD_OUT,
    )
)
def table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all gold tables, stored predictions among them, and whether each is ready."""
    star = adapters.star(spark, sf_dir, *_FACT_TABLES)
    made = {name: _predictions(spark, sf_dir, kind) for name, kind in _PREDICTION_TABLES.items()}
    return quality.table_status({name: star[name] for name in _TABLES + _FACT_TABLES} | made)


_HOURS_26, _HOURS_36, _HOURS_48 = 26 * 3600, 36 * 3600, 48 * 3600
_FRESH = {
    "energy": ("fact_energy_minute JOIN dim_datetime USING (datetime_key)", "max(timestamp_utc)", _HOURS_26, 7),
    "environment": ("fact_environment_minute JOIN dim_datetime USING (datetime_key)", "max(timestamp_utc)", _HOURS_26, 7),
    "presence": ("fact_presence_minute JOIN dim_datetime USING (datetime_key)", "max(timestamp_utc)", _HOURS_26, 7),
    "device health": ("fact_device_health_day JOIN dim_date USING (date_key)", "CAST(max(date) AS TIMESTAMP)", _HOURS_26, 7),
    "weather": ("fact_weather_hour JOIN dim_datetime USING (datetime_key)", "max(timestamp_utc)", _HOURS_36, 14),
    "motion predictions": ("held_out", f"CASE WHEN count(*) > 0 THEN TIMESTAMP '{adapters.NOW}' END", _HOURS_48, 14),
    "consumption predictions": ("held_out", f"CASE WHEN count(*) > 0 THEN TIMESTAMP '{adapters.NOW}' END", _HOURS_48, 14),
}


@query(
    oracles.over_star(
        """SELECT source, latest, epoch(TIMESTAMP '2024-02-01') - epoch(latest) AS age_seconds,
             CASE WHEN latest IS NULL THEN 'no data' WHEN epoch(TIMESTAMP '2024-02-01') - epoch(latest) < ok THEN 'ok'
                  WHEN epoch(TIMESTAMP '2024-02-01') - epoch(latest) < days * 86400 THEN 'warn' ELSE 'fail' END AS status
           FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{source}' AS source, {latest} AS latest, {ok} AS ok, {days} AS days FROM {rows}"
            for source, (rows, latest, ok, days) in _FRESH.items()
        )
        + ")",
        _SLOTS,
        _FEATURES,
        _HELD_OUT,
    )
)
def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row, age and status of every gold source, stored predictions among them."""
    minutes = {
        "energy": "fact_energy_minute", "environment": "fact_environment_minute", "presence": "fact_presence_minute"
    }
    star = adapters.star(spark, sf_dir, *minutes.values(), "fact_device_health_day", "fact_weather_hour")
    sources = {name: (star[table], "datetime_key", schemas.FRESHNESS_SENSORS) for name, table in minutes.items()}
    sources["device health"] = (star["fact_device_health_day"], "date_key", schemas.FRESHNESS_SENSORS)
    sources["weather"] = (star["fact_weather_hour"], "datetime_key", schemas.FRESHNESS_WEATHER)
    for name, kind in (("motion", "occupancy"), ("consumption", "consumption")):
        made = _predictions(spark, sf_dir, kind)
        sources[f"{name} predictions"] = (made, "prediction_made_at", schemas.FRESHNESS_PREDICTIONS)
    return freshness.freshness(sources, F.lit(adapters.NOW).cast("timestamp"))
