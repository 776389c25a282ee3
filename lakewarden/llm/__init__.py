"""Operators of a training-data pipeline, each with the query that applies it to a given table.

Task functions of this package travel whole to the executors, which need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
