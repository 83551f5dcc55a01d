"""Operators of a training-data pipeline (chat packing, licence scan, sharding,
language-model scoring, quality rules, near-duplicates, decontamination, URL
filter, toxicity, source mixing).  Nothing else in the library imports this
subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
