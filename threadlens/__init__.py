"""threadlens: topic analytics over chat logs, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions used inside Python workers travel with the job; executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
