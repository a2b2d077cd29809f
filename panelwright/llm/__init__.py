"""Operators of a training-data pipeline: tokens, quality, fingerprints and several kinds of deduplication.

Python workers need not have this package installed: its functions travel to them by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
