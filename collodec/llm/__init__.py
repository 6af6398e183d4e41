"""Operators for training-data pipelines: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# What runs in tasks travels with the job: executors need no copy of this subpackage.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
