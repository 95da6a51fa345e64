"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that a cluster runs them
# also where the package is not installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
