"""Flood-extent mapping on Spark: scene catalogs, pixel tables, elevation and areas of interest in, flood extents out."""

import sys

from pyspark import cloudpickle

# Ship the block helpers inside the tasks, so that executors need only numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
