"""spark-submit job: write the profiles of the raw tables or of the model features."""

from __future__ import annotations

import argparse

from delaylens import io
from delaylens.plans import profiles
from delaylens.session import get_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--base", required=True, help="folder with the input or staged tables")
    p.add_argument("--out", required=True, help="folder for one table per profile")
    p.add_argument("--of", choices=["raw", "features"], default="raw")
    p.add_argument("--suffix", default="")
    p.add_argument("--flights", default="flights")
    p.add_argument("--weather", default="weather/*")
    p.add_argument("--stations", default="stations/*")
    a = p.parse_args(argv)

    spark = get_session("delaylens-profile")
    if a.of == "features":
        tables = profiles.feature_profiles(io.read_table(spark, a.base, "features", a.suffix))
    else:
        tables = profiles.raw_profiles(
            io.read_table(spark, a.base, a.flights, a.suffix),
            io.read_table(spark, a.base, a.weather),
            io.read_table(spark, a.base, a.stations),
        )
    for name, table in tables.items():
        io.stage(table, f"{a.out}/{name}{a.suffix}")


if __name__ == "__main__":
    main()
