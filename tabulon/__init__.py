"""Tabular, text and sensor analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Helpers used inside tasks travel with the job: executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
