"""Where the stored tables live, and the jobs that load silver and refresh gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake import schemas, session
from hearthlake.functions import calendar
from hearthlake.operators import dedupe, flatten, forecasts
from hearthlake.plans import dimensions, facts
from hearthlake.sources import files as text_files
from hearthlake.sources import listing, locks, sensors, tables, weather as weather_source

SENSOR_EVENTS = "silver/sensor_events"
FORECASTS = "silver/weather_forecasts"
DI_ERRORS = "silver/di_errors_clean"
BUILDINGS = "silver/dim_buildings"
SENSOR_MANIFEST = "silver/etl_watermark"
WEATHER_MANIFEST = "silver/weather_watermark"
QUARANTINE = "silver/quarantine"
LOAD_COUNTS = "silver/load_counts"

MINUTE_FACTS: dict[str, Callable] = {
    "fact_energy_minute": facts.fact_energy_minute,
    "fact_environment_minute": facts.fact_environment_minute,
    "fact_presence_minute": facts.fact_presence_minute,
}


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("period", T.DateType())])


@dataclass
class Lake:
    """A folder of tables plus the settings of one installation.

    ``grain`` is the period of a stored partition. A day suits a steady stream of readings, where each tick rewrites
    the current day; sparse history is better kept by month, so that partitions do not become tiny.
    """

    spark: SparkSession
    root: str
    apartment_map: dict[str, str] = field(default_factory=dict)  # pattern in file name -> apartment
    building_patterns: dict[str, str] = field(default_factory=dict)  # pattern in building name -> apartment
    weather_sites: list[str] = field(default_factory=list)
    min_year: int = schemas.WEATHER_MIN_YEAR
    grain: str = "day"

    def with_period(self, df: DataFrame, ts: str = "timestamp") -> DataFrame:
        return df.withColumn("period", calendar.period(F.col(ts), self.grain))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def readings(self) -> DataFrame:
        return tables.read(self.spark, self.path(SENSOR_EVENTS), _stored(schemas.READINGS))

    def forecasts(self) -> DataFrame:
        return tables.read(self.spark, self.path(FORECASTS), _stored(schemas.FORECASTS))

    def errors(self) -> DataFrame:
        return tables.read(self.spark, self.path(DI_ERRORS), schemas.DI_ERRORS)

    def manifest(self, table: str = SENSOR_MANIFEST) -> DataFrame:
        return tables.read(self.spark, self.path(table), _stored(schemas.MANIFEST))

    def named_period(self, name: str) -> Column:
        """The period of the day in a file's name, by which manifests are partitioned."""
        return calendar.period(listing.named_day(calendar.canonical_name(F.col(name))), self.grain).alias("period")

    def load_counts(self) -> DataFrame:
        """Rows that each load had left after each of its stages."""
        return tables.read(self.spark, self.path(LOAD_COUNTS), schemas.LOAD_COUNTS)

    def quarantine(self) -> DataFrame:
        return tables.read(self.spark, self.path(QUARANTINE), schemas.QUARANTINE)

    def gold(self, name: str) -> DataFrame:
        """A gold table; facts have declared schemas, as a home may have no rows for one."""
        if name in schemas.FACTS:
            return tables.read(self.spark, self.path(f"gold/{name}"), _stored(schemas.FACTS[name]))
        return self.spark.read.parquet(self.path(f"gold/{name}"))

    def has_gold(self, name: str) -> bool:
        return tables.exists(self.spark, self.path(f"gold/{name}/_SUCCESS"))


# ---- bronze to silver -------------------------------------------------------------------------------------------


def _mark_done(lake: Lake, names: DataFrame, table: str, now: datetime) -> None:
    """Add canonical file names to a manifest; names already there are left alone. Only the periods in the names are read."""
    done = names.select(
        calendar.canonical_name(F.col("name")).alias("filename"),
        F.lit(now).cast("timestamp").alias("processed_at"),
        lake.named_period("name"),
    )
    known = tables.touched_partitions(lake.manifest(table), done, "period")
    fresh = tables.insert_if_absent(done, known, ["filename"])
    tables.append_by_period(session.materialise(fresh, "done"), lake.path(table), "period")


def _report(lake: Lake, job: str, now: datetime, counts: dict[str, int]) -> None:
    """Store the stage counts of a load."""
    rows = [(job, now, stage, n, rows) for n, (stage, rows) in enumerate(counts.items())]
    tables.append(lake.spark.createDataFrame(rows, schemas.LOAD_COUNTS).coalesce(1), lake.path(LOAD_COUNTS))


def _quarantine(lake: Lake, rejected: DataFrame) -> None:
    """Remember rejected files, once per path and modification time."""
    fresh = tables.insert_if_absent(rejected, lake.quarantine(), ["path", "modified"])
    tables.append(session.materialise(fresh, "quarantined"), lake.path(QUARANTINE))


def _as_periods(lake: Lake, periods: list[date]) -> DataFrame:
    return lake.spark.createDataFrame([(p,) for p in periods], "period date")


def load_sensors(lake: Lake, raw: DataFrame, now: datetime) -> DataFrame:
    """Flatten, upsert and mark a batch of sensor files; returns the periods it touched.

    The batch is parsed once. Readings are stored before their files are marked, so a failure in between only
    means that the same files are upserted again. Files that cannot be read are quarantined and never marked. How many
    files and readings came and stayed is counted while the parsed files are written, and stored per load.
    """
    counts = Observation("load_sensors")
    keyed = sensors.with_file_keys(raw, lake.apartment_map).filter(F.col("apartment").isNotNull())
    with session.scratch(lake.spark):
        parsed = session.materialise(flatten.observed(flatten.parse_payloads(keyed), counts), "parsed")
        readings = lake.with_period(flatten.readings_of(parsed))
        tables.upsert(
            readings,
            lake.path(SENSOR_EVENTS),
            schemas.READING_KEY,
            "period",
            order_by=flatten.last_reading_order(),
            cluster_by=["sensor_type", "field"],
        )
        _quarantine(lake, flatten.quarantined(parsed))
        _mark_done(lake, parsed.filter(~F.col("is_bad")), SENSOR_MANIFEST, now)
        _report(lake, "load_sensors", now, counts.get)
        good = parsed.filter(~F.col("is_bad") & (F.size("readings") > 0))
        periods = as_list(lake.with_period(good).select("period"))
    return _as_periods(lake, periods)


def load_weather(lake: Lake, raw: DataFrame, now: datetime) -> DataFrame:
    """Clean, upsert and mark a batch of forecast files; returns the periods it touched.

    The files are read once and their rows stored; what is rejected, kept and marked comes from there. A file that
    holds a header alone is done, one that cannot be read is quarantined. The rows left after each rule are counted while
    the rows are written, and stored per load; a file without rows counts as one raw row.
    """
    counts = Observation("load_weather")
    with session.scratch(lake.spark):
        rows = session.materialise(forecasts.observed(raw, counts, lake.min_year), "forecast_rows")
        rejected = session.materialise(forecasts.rejected_files(rows, lake.min_year), "rejected_files")
        usable = rows.join(rejected, "path", "left_anti")
        clean = session.materialise(lake.with_period(forecasts.clean_forecasts(usable, lake.min_year)), "clean_forecasts")
        tables.upsert(
            clean, lake.path(FORECASTS), schemas.FORECAST_KEY, "period", order_by=forecasts.last_forecast_order()
        )
        modified = F.col("modified") if "modified" in rows.columns else F.lit(None).cast("timestamp").alias("modified")
        names = rows.select("path", "name", modified).distinct()
        _quarantine(lake, names.join(rejected, "path").select("path", "name", "modified", "reason"))
        _mark_done(lake, names.join(rejected, "path", "left_anti"), WEATHER_MANIFEST, now)
        _report(lake, "load_weather", now, counts.get)
        periods = as_list(clean.select("period"))
    return _as_periods(lake, periods)


def _load_new(lake: Lake, root: str, glob: str, manifest: str, load: Callable[[DataFrame], DataFrame], lot: int) -> list[date]:
    """Load the files below ``root`` that were neither processed nor rejected in their present state, about ``lot`` at a time.

    The names are listed once and meet only those periods of the manifest that they carry. What is new stays a table: a lot is
    a range of modification times, so that no task gets a file outside it, joined with the new paths, so that known files
    inside it go before they are parsed.
    """
    spark = lake.spark
    files = text_files.open_files(spark, root, glob)
    touched: set[date] = set()
    with session.scratch(spark):
        listed = session.materialise(listing.described(files).select("*", lake.named_period("name")), "listed")
        unmarked = listing.new_files(listed, tables.touched_partitions(lake.manifest(manifest), listed, "period"))
        known = lake.quarantine().select("path", "modified")
        rejected = (unmarked["path"] == known["path"]) & unmarked["modified"].eqNullSafe(known["modified"])
        fresh = session.materialise(unmarked.join(known, rejected, "left_anti").select("path", "modified"), "fresh")
        for micros in listing.lots(fresh, lot):
            batch = files.filter(listing.within(micros)).join(fresh.select("path"), "path", "left_semi")
            touched |= set(as_list(load(text_files.texts(batch))))
    return sorted(touched)


def load_new_sensors(lake: Lake, root: str, now: datetime, lot: int = 100_000) -> list[date]:
    """Catch up on sensor files: the listing without the manifest, whatever a stream has seen. Returns the periods."""
    return _load_new(lake, root, sensors.PAYLOAD_GLOB, SENSOR_MANIFEST, lambda texts: load_sensors(lake, texts, now), lot)


def load_new_weather(lake: Lake, root: str, now: datetime, lot: int = 1000) -> list[date]:
    """Catch up on forecast files, as :func:`load_new_sensors`."""

    def load(texts: DataFrame) -> DataFrame:
        return load_weather(lake, weather_source.rows_of(texts), now)

    return _load_new(lake, root, weather_source.FORECAST_GLOB, WEATHER_MANIFEST, load, lot)


# ---- silver to gold ---------------------------------------------------------------------------------------------


def _grow(lake: Lake, name: str, key: str, build: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Append the members a dimension lacks; rows already stored are neither rewritten nor renumbered."""
    path = lake.path(f"gold/{name}")
    if not lake.has_gold(name):
        build(None).write.mode("overwrite").parquet(path)
        return lake.gold(name)
    existing = lake.gold(name)
    added = build(existing).join(existing.select(key), key, "left_anti")
    tables.append(session.materialise(added, name), path)
    return lake.gold(name)


def _replace(lake: Lake, name: str, rows: DataFrame) -> DataFrame:
    """Rewrite a small dimension whose stored rows may change."""
    tables.truncate_and_load(rows, lake.path(f"gold/{name}"))
    return lake.gold(name)


def refresh_dimensions(
    lake: Lake, readings: DataFrame, weather: DataFrame, tariffs: list | None = None
) -> dict[str, DataFrame]:
    """Bring all dimensions up to date with the given silver rows, and the tariffs with the given ones, if any."""
    spark = lake.spark
    for name in ("dim_apartment", "dim_tariff", "dim_datetime", "dim_date", "dim_weather_site", "dim_room", "dim_device"):
        tables.recover_table(spark, lake.path(f"gold/{name}"))
    found = session.materialise(dimensions.members(readings), "members")
    minutes = _grow(lake, "dim_datetime", "datetime_key", lambda e: dimensions.dim_datetime(readings, weather, e))
    days = minutes.select(F.col("timestamp_utc").alias("timestamp"))  # spares a second scan of silver
    dims = {
        "dim_datetime": minutes,
        "dim_date": _grow(lake, "dim_date", "date_key", lambda e: dimensions.dim_date(days, existing=e)),
    }
    sites = spark.createDataFrame([(s,) for s in lake.weather_sites], "site_name string")
    dims["dim_weather_site"] = _grow(lake, "dim_weather_site", "site_key", lambda e: dimensions.dim_weather_site(sites, e))

    buildings = spark.read.parquet(lake.path(BUILDINGS)) if tables.exists(spark, lake.path(BUILDINGS)) else None
    stored = lake.gold("dim_apartment") if lake.has_gold("dim_apartment") else None
    apartments = dimensions.dim_apartment(found, buildings, lake.building_patterns, stored)
    for site in lake.weather_sites[:1]:
        apartments = dimensions.link_weather_site(apartments, dims["dim_weather_site"], site)
    dims["dim_apartment"] = _replace(lake, "dim_apartment", apartments)

    dims["dim_room"] = _grow(lake, "dim_room", "room_key", lambda e: dimensions.dim_room(found, dims["dim_apartment"], e))
    dims["dim_device"] = _grow(
        lake,
        "dim_device",
        "device_key",
        lambda e: dimensions.dim_device(found, dims["dim_apartment"], dims["dim_room"], e),
    )
    stored = lake.gold("dim_tariff") if lake.has_gold("dim_tariff") else None
    given = {} if tariffs is None else {"tariffs": tariffs}
    dims["dim_tariff"] = _replace(lake, "dim_tariff", dimensions.dim_tariff(spark, **given, existing=stored))
    return dims


def _publish(lake: Lake, name: str, rows: DataFrame, whole: bool, lock: locks.Lock) -> DataFrame:
    """Replace the periods that ``rows`` covers, or the whole fact, so that periods gone from silver go here too.

    Facts derive from silver alone, so a failed run is simply repeated.
    """
    schema = schemas.FACTS[name]
    day = calendar.day_of_key(F.col("date_key")).cast("timestamp")
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    dated = typed.withColumn("period", calendar.period(day, lake.grain)).hint("rebalance", "period")
    tables.replace_partitions(dated, lake.path(f"gold/{name}"), ["period"], whole, check=lock.check)
    return lake.gold(name)


def _within(df: DataFrame, periods: list[date] | None) -> DataFrame:
    return df if periods is None else df.filter(F.col("period").isin(periods))


def _alone(lake: Lake):
    """One refresh of a lake at a time: dimensions are rewritten in place and may not get a member twice."""
    return locks.held(lake.spark, lake.path("_refreshing"), LEASE_SECONDS)


LEASE_SECONDS = locks.LEASE_SECONDS


def _prices(lake: Lake) -> set[tuple]:
    """Stored prices: a few rows a year."""
    return {tuple(row) for row in lake.gold("dim_tariff").select("provider", "year", "chf_per_kwh").collect()} if lake.has_gold("dim_tariff") else set()


def refresh_gold(
    lake: Lake, periods: list[date] | None = None, sensor: bool = True, weather: bool = True, tariffs: list | None = None
) -> dict[str, DataFrame]:
    """Rebuild gold for the given periods, or for all. Only those silver partitions are read.

    Costs follow a changed price in all periods of its year. Two refreshes of one lake wait for each other.
    """
    readings, outlook = _within(lake.readings(), periods), _within(lake.forecasts(), periods)
    whole = periods is None
    with _alone(lake) as lock, session.scratch(lake.spark):
        before = _prices(lake)
        gold = refresh_dimensions(lake, readings, outlook, tariffs)
        if sensor:
            for name, build in MINUTE_FACTS.items():
                gold[name] = _publish(lake, name, build(readings, gold), whole, lock)
            errors = _within(lake.with_period(lake.errors()), periods)
            name = "fact_device_health_day"
            gold[name] = _publish(lake, name, facts.fact_device_health_day(readings, errors, gold), whole, lock)
            years = {year for _, year, _ in _prices(lake) ^ before}
            energy = gold["fact_energy_minute"]
            if not whole:
                energy = energy.filter(F.col("period").isin(periods) | F.year("period").isin(list(years)))
            energy = energy.drop("period")
            costed = facts.energy_with_cost(energy, gold["dim_date"], gold["dim_tariff"])
            gold["mv_energy_with_cost"] = _publish(lake, "mv_energy_with_cost", costed, whole, lock)
        if weather:
            hours = facts.fact_weather_hour(outlook, gold["dim_weather_site"])
            gold["fact_weather_hour"] = _publish(lake, "fact_weather_hour", hours, whole, lock)
    return gold


def as_list(periods: DataFrame) -> list[date]:
    """Touched periods on the driver: at most one value per calendar day."""
    return [row[0] for row in periods.distinct().collect()]


# ---- backfill ---------------------------------------------------------------------------------------------------


class DuplicateKeysError(RuntimeError):
    """Raised when a backfill still holds duplicate keys; carries up to five of them."""


def verify_unique(df: DataFrame, keys: list[str]) -> None:
    samples = dedupe.top_duplicate_keys(df, keys).collect()
    if samples:
        raise DuplicateKeysError(f"duplicate keys remain: {[row.asDict() for row in samples]}")


def backfill(lake: Lake, raw: DataFrame, now: datetime) -> None:
    """Load history in one go: flatten, drop duplicates keeping the oldest row, verify, publish, mark."""
    keyed = sensors.with_file_keys(raw, lake.apartment_map).filter(F.col("apartment").isNotNull())
    with session.scratch(lake.spark):
        parsed = session.materialise(flatten.parse_payloads(keyed), "parsed")
        new = lake.with_period(flatten.readings_of(parsed))
        old = tables.touched_partitions(lake.readings(), new, "period").withColumns(
            {"_file_ts": F.lit(None).cast("timestamp"), "_path": F.lit(None).cast("string")}
        )
        oldest_first = [F.asc_nulls_first("_file_ts"), F.asc_nulls_first("_path"), F.asc_nulls_last("value"), F.asc("unit")]
        merged = dedupe.one_per_key(old.unionByName(new), schemas.READING_KEY, oldest_first).drop("_file_ts", "_path")
        staged = session.materialise(merged, "backfill")
        verify_unique(staged, schemas.READING_KEY)
        arranged = staged.hint("rebalance", "period").sortWithinPartitions("period", "sensor_type", "field")
        tables.replace_partitions(arranged, lake.path(SENSOR_EVENTS), ["period"])
        _quarantine(lake, flatten.quarantined(parsed))
        _mark_done(lake, parsed.filter(~F.col("is_bad")), SENSOR_MANIFEST, now)
