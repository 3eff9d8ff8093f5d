"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions that tasks run travel with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
