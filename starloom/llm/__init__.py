"""Operators for training-data corpora: dedup, filtering, scoring, extraction, packing, token files.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
