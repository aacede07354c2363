"""Training-data pipeline operators. Nothing outside this folder imports it.

Functions that run inside tasks travel to the executors by value, so the package need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
