from . import timeutil

__all__ = ["timeutil"]
