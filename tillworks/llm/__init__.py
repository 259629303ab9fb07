"""Preparing training data: archives, sharding, decontamination, mixing, scoring, packing, search and de-duplication.

The functions that run inside tasks are sent to the executors by value, so that the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
