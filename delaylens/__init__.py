"""Departure-delay analytics on Spark DataFrames."""

from delaylens.functions import timeutil, zoneoffsets
from delaylens.operators import (
    boosting,
    bridge,
    certify,
    clean,
    evaluate,
    features,
    graph,
    joins,
    lagjoin,
    models,
    ordered,
    oversample,
    profile,
    rollup,
    sampling,
    scaling,
    split,
    tuning,
)
from delaylens.sources import io, schemas

__all__ = [
    "boosting", "bridge", "certify", "clean", "evaluate", "features", "graph", "io", "joins", "lagjoin", "models", "ordered",
    "oversample", "profile", "rollup", "sampling", "scaling", "schemas", "split", "timeutil", "tuning", "zoneoffsets",
]
