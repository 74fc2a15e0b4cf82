"""Operators of a training-data pipeline over large text tables.

Nothing else in the library imports this package. Functions that run inside
tasks are shipped to the executors by value, so workers need not have the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
