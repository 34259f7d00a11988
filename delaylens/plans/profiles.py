"""The standard profiles of raw tables and of model features, as named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators import profile, sampling
from delaylens.session import checkpointed
from delaylens.sources import schemas


BY = ["MONTH", "FL_DATE", "DAY_OF_WEEK", "late"]
READINGS = ["HourlyPrecipitation", "HourlyWindSpeed"]


def raw_profiles(flights: DataFrame, weather: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Sizes, missing values, rates, delays over time and sensor distributions.

    Flights are read three times: for all plain measures, for all groups, and, with the
    ranges known, for all histograms.
    """
    delays = ["DEP_DELAY", "ARR_DELAY"]
    summary = profile.Summary(flights, delays, ["CANCELLED", "DIVERTED"])
    dated = flights.withColumn("late", F.col("DEP_DELAY") > 15).select(*BY, *delays)
    sets = dated.groupingSets([[F.col(c)] for c in BY], *BY)
    # the bit of a column is 0 where its own groups are
    groups = checkpointed(
        sets.agg(F.grouping_id().alias("set"), F.count("*").alias("n"), *[F.avg(c).alias(c) for c in delays])
    )
    own = {c: groups.filter(F.col("set") == 2 ** len(BY) - 1 - 2 ** (len(BY) - 1 - i)) for i, c in enumerate(BY)}
    sensors = profile.Summary(weather, READINGS)
    tables = {
        "shape_flights": summary.shape(),
        "shape_weather": sensors.shape(),
        "shape_stations": profile.shape(stations),
        "missing_flights": summary.missing(),
        "missing_weather": sensors.missing(),
        "describe_delay": summary.describe(delays),
        "null_delay": summary.null_count("DEP_DELAY"),
        "rates": summary.flag_rate(["CANCELLED", "DIVERTED"]),
        "arrival_delay_by_month": own["MONTH"].select("MONTH", F.col("ARR_DELAY").alias("mean")),
        "delay_by_date": own["FL_DATE"].select("FL_DATE", F.col("DEP_DELAY").alias("mean")),
        "delay_by_weekday": own["DAY_OF_WEEK"].select("DAY_OF_WEEK", F.col("DEP_DELAY").alias("mean")),
        "late_flights": own["late"].filter("late IS NOT NULL").select("late", "n"),
        "station_count": profile.ndv(weather, "STATION"),
        **profile.histograms(
            flights,
            {
                "delay_histogram": ("DEP_DELAY", 50, *summary.range("DEP_DELAY")),
                "delay_histogram_0_400": ("DEP_DELAY", 50, 0, 400),
            },
        ),
        **profile.histograms(weather, {f"histogram_{c}": (c, 10, *sensors.range(c)) for c in READINGS}),
    }
    for c in READINGS:
        tables[f"box_{c}"] = profile.box_stats(weather.select(F.col(c).try_cast("double").alias(c)), c)
    return tables


def feature_profiles(features: DataFrame, label: str = "delay_label") -> dict[str, DataFrame]:
    """Class balance, correlations, label by indicator, spreads by label and busiest airports."""
    flags = ["is_holiday", *schemas.SEASONS, *schemas.DAY_PARTS]
    delays = profile.delays_by_airport(features, label=label)
    tables = {
        "class_counts": sampling.class_counts(features, label),
        "correlation": profile.correlation(features, [label, *flags, *schemas.NUMERIC_FEATURES]),
        "label_by_flag": profile.label_by_flag(features, flags, label),
        "top_airports": profile.top_k(
            features.select("airport_iata", "dep_rank").distinct(), [F.col("dep_rank").desc(), F.col("airport_iata")]
        ),
        "most_delayed_airports": profile.top_k(delays, [F.col("delays").desc(), F.col("airport_iata")]),
    }
    summary = profile.Summary(features, [label, *schemas.NUMERIC_FEATURES])
    tables["missing_features"] = summary.missing()
    wanted = {f"histogram_{c}": (c, 10, *summary.range(c)) for c in schemas.NUMERIC_FEATURES}
    wanted["label_histogram"] = (label, 2, *summary.range(label))
    tables |= profile.histograms(features, wanted)
    for c in ("hourly_visibility", "hourly_wind_speed", "daily_precipitation"):
        tables[f"box_{c}"] = profile.box_stats(features, c, label)
    return tables
