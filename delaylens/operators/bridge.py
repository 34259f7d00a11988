"""Link sensor stations to airports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators.clean import dedup, project, rename
from delaylens.operators.joins import lookup
from delaylens.sources.schemas import STATION_NAMES


def station_airport(stations: DataFrame, airports: DataFrame, names: dict[str, str] = STATION_NAMES) -> DataFrame:
    """Distinct stations with the airport that shares their call sign."""
    stations = dedup(rename(project(stations, list(names)), names))
    dim = airports.select(F.col("call").alias("station_call"), F.col("iata").alias("airport_iata"))
    joined = lookup(stations, dim, ["station_call"])
    return joined.select(*names.values(), "airport_iata")


def attach_airport(weather: DataFrame, station_airports: DataFrame, station: str = "STATION") -> DataFrame:
    """Readings of known stations, with the station's columns; others are dropped."""
    dim = station_airports.withColumnRenamed("station_id", station)
    return lookup(weather, dim, [station]).withColumnRenamed(station, "station_id")
