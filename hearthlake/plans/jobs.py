"""Jobs on a lake beside loading and refreshing: the registry, predictions, and erasure of an apartment."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import schemas, session
from hearthlake.functions import cleaning
from hearthlake.operators import errors, privacy
from hearthlake.plans import facts, lake as lakes, ml
from hearthlake.sources import registry, sensors, tables

ERROR_LOG = "dierrors"
BRONZE = "bronze/sensors"
PREDICTIONS = {
    "gold/fact_prediction_motion": schemas.PREDICTION_MOTION,
    "gold/fact_prediction_consumption": schemas.PREDICTION_CONSUMPTION,
}


def load_registry(
    lake: lakes.Lake,
    available: Iterable[str],
    read: Callable[[str], DataFrame],
    allow: dict[str, Iterable[str]] | None = None,
) -> list[str]:
    """Snapshot the registry tables into silver, then type and classify its error log; returns the tables written.

    A registry without an error log leaves the stored errors as they are.
    """
    spark = lake.spark

    def write(name: str, snapshot: DataFrame) -> None:
        tables.truncate_and_load(snapshot, lake.path(f"silver/{name}"))

    written = registry.import_registry(available, read, write, allow)
    log = schemas.REGISTRY_TABLES[ERROR_LOG]
    if log in written:
        buildings = lake.path(lakes.BUILDINGS)
        houses = spark.read.parquet(buildings) if tables.exists(spark, buildings) else None
        clean = errors.clean_di_errors(spark.read.parquet(lake.path(f"silver/{log}")), houses, lake.building_patterns)
        tables.truncate_and_load(clean, lake.path(lakes.DI_ERRORS))
        written.append(lakes.DI_ERRORS.split("/")[1])
    return written


def predict(lake: lakes.Lake, now: datetime) -> dict[str, DataFrame]:
    """Fit both models on the slots whose outcome is known, predict every slot, and upsert what was predicted.

    Known outcomes of earlier predictions are filled in on the way, as a slot is predicted again with its outcome.
    Nothing is written for a model without known outcomes.
    """
    gold = {name: lake.gold(name) for name in ("dim_apartment", "dim_room", "fact_weather_hour")}
    slots = facts.room_slots(lake.gold("fact_energy_minute"), lake.gold("fact_presence_minute"), gold)
    made_at = F.lit(now).cast("timestamp")
    out = {}
    with session.scratch(lake.spark):
        rows = session.materialise(ml.features(slots, gold["fact_weather_hour"], gold["dim_apartment"]), "features")
        models = {
            "gold/fact_prediction_motion": ("label_occupied", ml.fit_occupancy, ml.predict_occupancy),
            "gold/fact_prediction_consumption": ("label_power_w", ml.fit_consumption, ml.predict_consumption),
        }
        for path, (label, fit, model) in models.items():
            if rows.filter(F.col(label).isNotNull()).isEmpty():
                continue
            ml.store_predictions(model(fit(rows), rows, made_at), lake.path(path), lake.grain)
            out[path.split("/")[1]] = lake.spark.read.parquet(lake.path(path)).drop("period")
    return out


def erase_apartments(lake: lakes.Lake, apartments: list[str]) -> list[str]:
    """Rewrite every stored table that holds the apartments, without them; returns the tables rewritten.

    Landed payloads, silver, the names of their files in manifest and quarantine, gold and predictions are covered.
    Rooms and devices go by the stored dimensions, which are rewritten last, so an interrupted erasure can be repeated.
    """
    spark = lake.spark
    leaving = spark.createDataFrame([(a,) for a in apartments], "apartment string")
    patterns = {p: a for p, a in lake.apartment_map.items() if a in apartments}

    def named(df: DataFrame, column: str) -> DataFrame:
        return df.filter(cleaning.by_pattern(F.col(column), patterns).isNull()) if patterns else df

    done = []
    with lakes._alone(lake), session.scratch(spark):
        dimensions = {name: lake.gold(name) for name in ("dim_apartment", "dim_room") if lake.has_gold(name)}

        def rewrite(path: str, df: DataFrame, partition_by: list[str], left: Callable[[DataFrame], DataFrame]) -> None:
            tables.rewrite(left(df), lake.path(path), partition_by)
            done.append(path)

        def without(name: str) -> Callable[[DataFrame], DataFrame]:
            return lambda df: privacy.erase({name: df}, leaving, dimensions)[name]

        stored: list[tuple[str, DataFrame, list[str], Callable]] = [
            (lakes.SENSOR_EVENTS, lake.readings(), ["period"], lambda df: df.join(leaving, "apartment", "left_anti")),
            (lakes.DI_ERRORS, lake.errors(), [], lambda df: df.join(leaving, "apartment", "left_anti")),
            (lakes.SENSOR_MANIFEST, lake.manifest(), ["period"], lambda df: named(df, "filename")),
            (lakes.QUARANTINE, lake.quarantine(), [], lambda df: named(df, "name")),
        ]
        if tables.exists(spark, lake.path(BRONZE)):
            landed = sensors.read_bronze(spark, lake.path(BRONZE))
            stored.append((BRONZE, landed, ["apartment", "period"], lambda df: df.join(leaving, "apartment", "left_anti")))
        for path in PREDICTIONS:
            if tables.exists(spark, lake.path(path)):
                predictions = spark.read.parquet(lake.path(path))
                stored.append((path, predictions, ["period"], lambda df: df.join(leaving, "apartment", "left_anti")))
        for name in schemas.FACTS:
            if "apartment_key" in schemas.FACTS[name].names:
                stored.append((f"gold/{name}", lake.gold(name), ["period"], without(name)))
        stored += [(f"gold/{n}", lake.gold(n), [], without(n)) for n in ("dim_device", "dim_room", "dim_apartment") if lake.has_gold(n)]
        for path, df, partition_by, left in stored:
            if tables.exists(spark, lake.path(path)):
                rewrite(path, df, partition_by, left)
    return done
