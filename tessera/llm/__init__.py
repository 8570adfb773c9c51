"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
``opN_*`` queries and their SQL; every other module is one operator or a helper.
"""

import sys

from pyspark import cloudpickle

# Functions for Arrow batches travel with the job; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
