"""Operators for large text corpora: search, duplicates, scoring, mixing, coding, packing."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the job, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
