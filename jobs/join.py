"""spark-submit job: staged flights and weather to the table of model features."""

from __future__ import annotations

import argparse

from delaylens import io
from delaylens.plans import flights as flow
from delaylens.session import get_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--base", required=True, help="folder with the staged tables")
    p.add_argument("--holidays", required=True, help="path of a CSV file with columns Date, Holiday and Year")
    p.add_argument("--first-year", type=int, default=2015)
    p.add_argument("--suffix", default="")
    p.add_argument("--compat", action="store_true", help="scores without teleport or dangling mass")
    p.add_argument("--last-year", type=int, default=2021, help="held-out year")
    p.add_argument("--rank-on", choices=["train", "all"], default="train", help="years whose routes are scored")
    a = p.parse_args(argv)

    spark = get_session("delaylens-join")
    joined = flow.join_weather(
        io.read_table(spark, a.base, "flights", a.suffix), io.read_table(spark, a.base, "station_weather", a.suffix)
    )
    joined = io.stage(joined, f"{a.base}/flight_weather{a.suffix}", ["year"])
    holidays = io.read_delimited(spark, a.holidays, header=True).filter(f"Year >= {a.first_year}")
    last_year = a.last_year if a.rank_on == "train" else None
    features = flow.select_features(flow.add_context(joined, holidays, a.compat, last_year))
    io.stage(features, f"{a.base}/features{a.suffix}", ["year"])


if __name__ == "__main__":
    main()
