"""Training-data operators: one module per operator, ``registry`` names their queries.

Each module has a general operator (DataFrames in, DataFrames out, real texts, spans or
files) and a thin ``query(spark, sf_dir)`` that applies it to a whole table. Nothing else
in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
