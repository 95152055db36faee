"""Archivolt: archive analytics expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions travel to the executors by value, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
