"""Preparing text corpora for training: near copies, lines, quality, mixing, packing."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
