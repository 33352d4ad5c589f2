"""Operators for training-data pipelines: one module per operator, registered in ``queries``."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value: they need no copy of it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
