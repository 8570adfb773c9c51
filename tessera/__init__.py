"""tessera: spatial-omics slide analytics as Spark DataFrame operators.

Sub-packages
------------
functions   Column-level helpers (keys, colours, parsers, scales).
sources     Readers, file inventory, sinks.
operators   DataFrame -> DataFrame operators (cells, transcripts, raster,
            segmentation versions, layers, run log).
plans       End-to-end jobs and the bindings of operators to input tables.
streaming   Incremental (availableNow) ingestion of newly arrived slide files.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions for Arrow batches travel with the job; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
