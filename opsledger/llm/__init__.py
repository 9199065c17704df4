"""Operators for training data. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# workers get the functions of this folder with the job, so it need not be installed on them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
