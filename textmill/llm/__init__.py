"""Operators for preparing large training corpora (see README, "Corpus operators").

Functions of this subpackage that run inside tasks travel with the job, so
executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
