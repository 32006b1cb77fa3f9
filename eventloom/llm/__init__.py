"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Tasks carry the code of these modules with them, so executors need not have the package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
