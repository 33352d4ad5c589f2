"""cartpulse: real-time commerce metrics on PySpark.

Daily active devices, gross order value, coupon-abuse alerts, change-log
capture and a sale-detail dashboard, written as DataFrame / SQL plans and
Structured Streaming queries.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel by value: executors need no copy of the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
