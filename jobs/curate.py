"""spark-submit job: raw tables to staged airport-hour weather and flights."""

from __future__ import annotations

import argparse

from delaylens import io, schemas
from delaylens.plans import flights as flow
from delaylens.session import get_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--base", required=True, help="folder with the input tables")
    p.add_argument("--out", required=True, help="folder for the staged tables")
    p.add_argument("--suffix", default="", help="table-name suffix of a data-size variant")
    p.add_argument("--flights", default="flights")
    p.add_argument("--weather", default="weather/*")
    p.add_argument("--stations", default="stations/*")
    p.add_argument("--airports", required=True, help="path of the ':'-separated airport file")
    p.add_argument("--zones", required=True, help="path of a CSV file with columns iata and tz")
    p.add_argument("--compat", action="store_true", help="origin-zone arrival times and literal night hours")
    p.add_argument("--lean", action="store_true", help="keep only the numeric weather columns")
    a = p.parse_args(argv)

    spark = get_session("delaylens-curate")
    airports = io.read_delimited(spark, a.airports, schemas.AIRPORTS, sep=":")
    zones = io.read_delimited(spark, a.zones, header=True).select("iata", "tz")
    weather = io.read_table(spark, a.base, a.weather)
    stations = io.read_table(spark, a.base, a.stations)
    hourly = flow.curate_weather(weather, stations, airports, zones, [] if a.lean else None)
    io.stage(hourly, f"{a.out}/station_weather{a.suffix}")
    raw = io.read_table(spark, a.base, a.flights, a.suffix)
    io.stage(flow.curate_flights(raw, zones, a.compat), f"{a.out}/flights{a.suffix}", ["year"])


if __name__ == "__main__":
    main()
