"""docspark: turn raw documents into clean, quality-gated tables with PySpark."""

import sys

from pyspark import cloudpickle

# Functions handed to executors travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
