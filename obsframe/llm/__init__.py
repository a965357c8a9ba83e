"""Operators for training-data pipelines. Nothing else in the package imports this subpackage."""

from pyspark import cloudpickle

import obsframe

# Tasks get the code of this package with the query, so executors need no copy of it.
cloudpickle.register_pickle_by_value(obsframe)
