"""Operators: each takes and returns DataFrames (or columns) and collects nothing."""

import sys

from pyspark import cloudpickle

# The few Python helpers travel inside the tasks, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["folioworks"])
