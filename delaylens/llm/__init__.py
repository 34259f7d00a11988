"""Operators for preparing language-model training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# tasks get these modules' functions with their code, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
